"""Tab-separated event files: scan, clean-up and export."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiatus.schema import EVENT_COLUMNS, RAW_EVENTS, TIMESTAMP_PATTERN

# Stands for null in exports, so that an empty text stays one.
NULL_MARKER = "\\N"

# Both directions: nothing is trimmed, and times have all six digits.
_EXPORT = {
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "charToEscapeQuoteEscaping": "\\",
}


def read_raw_tsv(spark: SparkSession, path: str, quote: str | None = None) -> DataFrame:
    """Headerless TSV with the fixed schema; nothing is inferred.

    Spark's default double-quote handling applies. Pass ``quote=""`` for files
    in which a double quote is ordinary text.
    """
    reader = spark.read.schema(RAW_EVENTS).option("sep", "\t").option("header", False)
    if quote is not None:
        reader = reader.option("quote", quote)
    return reader.csv(str(path))


def parse_start(raw: Column) -> Column:
    """Event time, or null where the text does not follow the pattern.

    The closing Z is read as the UTC zone, whatever the session's zone is.
    """
    return F.when(raw.endswith("Z"), F.try_to_timestamp(raw, F.lit(TIMESTAMP_PATTERN)))


def normalize_events(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed events: parsed time, first non-null song id, unusable rows dropped."""
    usable = raw.filter(F.col("track_name").isNotNull()).select(
        "*",
        parse_start(F.col("started_at_raw")).alias("started_at"),
        F.coalesce("track_id", "track_name").alias("song_id"),
    )
    return usable.filter(F.col("started_at").isNotNull()).select(*EVENT_COLUMNS, *keep)


def read_tsv(spark: SparkSession, path: str, quote: str | None = None) -> DataFrame:
    return normalize_events(read_raw_tsv(spark, path, quote))


def write_tsv(
    result: DataFrame,
    path: str,
    *,
    header: bool = True,
    single_file: bool = False,
    null_value: str = NULL_MARKER,
) -> str:
    """Write a result as TSV files under ``path``.

    Texts keep their spaces and times their microseconds; :func:`read_export`
    gives the same rows back. A null is written as ``null_value``, an empty text as ``""``,
    and a text that looks like the marker with one more backslash. With an empty
    ``null_value``, as event files have it, the two can't be told apart in reading.
    Top-k results already sit in one partition and keep their order. Set
    ``single_file`` only for results whose size a limit bounds; everything
    else is written in parallel.
    """
    frame = result.coalesce(1) if single_file else result
    if null_value == NULL_MARKER:
        frame = _texts(frame, lambda c: F.when(c.rlike(r"^\\+N$"), F.concat(F.lit("\\"), c)).otherwise(c))
    (
        frame.write.mode("overwrite")
        .option("sep", "\t")
        .option("header", header)
        .option("nullValue", null_value)
        .options(**_EXPORT)
        .csv(str(path))
    )
    return str(path)


def read_export(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    *,
    header: bool = True,
    null_value: str = NULL_MARKER,
) -> DataFrame:
    """The rows that :func:`write_tsv` wrote, with the same ``null_value``."""
    reader = spark.read.schema(schema).option("sep", "\t").option("header", header).option("nullValue", null_value)
    rows = reader.options(**_EXPORT).option("multiLine", True).csv(str(path))
    if null_value != NULL_MARKER:
        return rows
    return _texts(rows, lambda c: F.when(c.rlike(r"^\\{2,}N$"), F.substring(c, 2, 2**31 - 1)).otherwise(c))


def _texts(frame: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    names = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.StringType)]
    return frame.withColumns({name: change(F.col(name)) for name in names})
