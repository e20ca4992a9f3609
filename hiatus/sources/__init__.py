from hiatus.sources.delimited import (
    normalize_events,
    parse_start,
    read_export,
    read_raw_tsv,
    read_tsv,
    write_tsv,
)
from hiatus.sources.staged import (
    load_events,
    read_staged,
    stage_events,
    staged_exists,
)

__all__ = [
    "load_events",
    "normalize_events",
    "parse_start",
    "read_export",
    "read_raw_tsv",
    "read_staged",
    "read_tsv",
    "stage_events",
    "staged_exists",
    "write_tsv",
]
