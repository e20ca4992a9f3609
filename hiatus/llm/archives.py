"""Web archives: WARC records as splittable text, checked by their chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hiatus.functions import utc_clock
from hiatus.llm.tables import fresh, new_path, text_bytes, written

#: Payloads of at least this many bytes are stored once.
REVISIT_BYTES = 1000

# Fixed values of the WARC format.
MAGIC = "WARC/1."
VERSION = "1"
RECORD_END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEADER = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
RECORD_ID = "urn:page:"


def with_record_types(
    pages: DataFrame, ident: str = "page_id", payload: str = "html", least: int = REVISIT_BYTES
) -> DataFrame:
    """Adds ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to``.

    Of equal payloads of at least ``least`` bytes the one with the largest id is the
    response and the others revisit it; all smaller ones are responses. Rows that
    share the largest id are all responses, as are those whose id is null while
    no equal payload has one. Equality is that of length and SHA-1. A null payload
    is empty. Only digests that occur twice are joined back, so pages are not
    shuffled unless that table is large.
    """
    body = text_bytes(payload)
    ours = ("payload_bytes", "payload_digest", "record_type", "refers_to")
    base = pages.drop(*[c for c in ours if c not in (ident, payload)])
    sized = base.withColumns(
        {"payload_bytes": F.octet_length(body).cast("long"), "payload_digest": F.sha1(body)}
    )
    digest, size, newest = (fresh(sized, c) for c in ("_digest", "_size", "_newest"))
    repeated = written(
        sized.where(F.col("payload_bytes") >= least)
        .groupBy(F.col("payload_digest").alias(digest), F.col("payload_bytes").alias(size))
        .agg(F.max(ident).alias(newest), F.count("*").alias("_rows"))
        .where("_rows > 1")
        .drop("_rows"),
        "repeated-payloads",
    )
    joined = sized.join(
        repeated, (F.col("payload_digest") == F.col(digest)) & (F.col("payload_bytes") == F.col(size)), "left"
    )
    revisit = F.col(newest).isNotNull() & ~F.col(ident).eqNullSafe(F.col(newest))
    return joined.withColumns(
        {
            "record_type": F.when(revisit, "revisit").otherwise("response"),
            "refers_to": F.when(revisit, F.col(newest)),
        }
    ).drop(digest, size, newest)


def write_archives(
    pages: DataFrame, path: str, ident: str = "page_id", url: str = "url", payload: str = "html"
) -> None:
    """Writes a response or revisit record for every page below ``path``.

    Expects the columns of ``with_record_types``. A file is written by each task,
    through Spark's text sink with the record end as separator, so any file
    system that Spark writes to will do. Control characters in an address are
    escaped; a null address or id is left out of the header.
    """
    body = text_bytes(payload)
    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit(HTTP_HEADER + "Content-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n")
    )
    block = F.when(revisit, http).otherwise(F.concat(http, body.cast("string")))
    address = F.regexp_replace(F.col(url).cast("string"), r"[\x00-\x20\x7F]", "%20")

    clock = utc_clock(F.current_timestamp()).cast("string")

    def field(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    def record_id(value: Column) -> Column:
        return F.concat(F.lit(f"<{RECORD_ID}"), value.cast("string"), F.lit(">"))

    record = F.concat(
        F.lit(f"{MAGIC}{VERSION}\r\n"),
        field("WARC-Type", F.col("record_type")),
        field("WARC-Record-ID", record_id(F.col(ident))),
        field("WARC-Date", F.concat(F.translate(F.substring(clock, 1, 19), " ", "T"), F.lit("Z"))),
        field("WARC-Target-URI", address),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        field("WARC-Refers-To", record_id(F.col("refers_to"))),
        field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )
    pages.select(record.alias("value")).write.option("lineSep", RECORD_END).text(path)


def _placed(rows: DataFrame) -> DataFrame:
    """Adds ``offset``: the byte at which each row's value begins in its file.

    Rows of a split are in the order of ``turn``; sums of ``size`` inside a split
    and over a file's earlier splits give the offset. A split is the largest
    group that a task sorts.
    """
    before = Window.partitionBy("file", "split").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    ordered = written(rows.withColumn("inside", F.coalesce(F.sum("size").over(before), F.lit(0))), "scanned")
    splits = ordered.groupBy("file", "split").agg(F.sum("size").alias("size"))
    bases = written(
        splits.select("file", "split", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base")), "splits"
    )
    return (
        ordered.join(bases, ["file", "split"])
        .withColumn("offset", F.col("base") + F.col("inside"))
        .drop("base", "inside")
        .where("offset > 0")  # what stands before a file's first magic
    )


def _candidates(rows: DataFrame) -> DataFrame:
    """Rows that stand at a file's first magic or right after a record's end.

    Adds ``header_end``: where the header ends, which for a header that itself holds the
    magic is the first end in a later piece. A piece without an end follows one
    with an end or is no candidate, so such headers never overlap.
    """
    order = Window.partitionBy("file", "split").orderBy("turn")
    # From the end backwards, as Spark sums up each frame anew that ends with the partition.
    onward = Window.partitionBy("file", "split").orderBy(F.desc("turn")).rowsBetween(Window.unboundedPreceding, 0)
    of_file = Window.partitionBy("file").orderBy("split")
    later = Window.partitionBy("file").orderBy(F.desc("split")).rowsBetween(Window.unboundedPreceding, -1)
    marked = written(
        rows.withColumn("end", F.when(F.col("rest") >= 0, F.col("offset") + F.col("header_bytes")))
        .withColumn("after_end", F.lag("ends").over(order))
        .withColumn("header_end", F.last("end", ignorenulls=True).over(onward)),
        "pieces",
    )
    splits = marked.groupBy("file", "split").agg(
        F.max_by("ends", "turn").alias("ends"), F.min("end").alias("first_end")
    )
    around = written(
        splits.select(
            "file",
            "split",
            # Nothing before: the file's first magic.
            F.coalesce(F.lag("ends").over(of_file), F.lit(True)).alias("split_after_end"),
            F.last("first_end", ignorenulls=True).over(later).alias("later_end"),
        ),
        "split-borders",
    )
    return (
        marked.join(around, ["file", "split"])
        .where(F.coalesce("after_end", "split_after_end"))
        .withColumn("header_end", F.coalesce("header_end", "later_end"))
        .drop("end", "after_end", "split_after_end", "later_end", "ends")
    )


def _scan(spark: SparkSession, path: str) -> DataFrame:
    """What follows each magic, up to the next one; files are read in splits."""
    return (
        spark.read.option("lineSep", MAGIC)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("turn"),
            (F.octet_length("value") + len(MAGIC)).cast("long").alias("size"),
            F.endswith("value", F.lit(RECORD_END)).alias("ends"),
            "value",
        )
    )


def _described(rows: DataFrame) -> DataFrame:
    """Reads the header in ``value``, and the payload if the record is complete."""

    def field(name: str) -> Column:
        found = F.regexp_extract("header", rf"(?im)^{name}:[ \t]*<?(?:{RECORD_ID}|sha1:)?([^>\r\n]*?)>?[ \t]*\r?$", 1)
        return F.when(found != "", found)

    end = len(RECORD_END)
    header_bytes = F.octet_length(F.substring_index("value", RECORD_END, 1)).cast("long")
    described = (
        rows.withColumn("header_bytes", header_bytes)
        .withColumn("rest", F.octet_length("value") - F.col("header_bytes") - end)
        .withColumn("header", F.when(F.col("rest") >= 0, F.substring_index("value", RECORD_END, 1)))
        .withColumn("declared", F.expr("try_cast(regexp_extract(header, '(?im)^Content-Length:[ \\t]*([0-9]+)[ \\t]*\\r?$', 1) AS BIGINT)"))
        .withColumn("complete", F.coalesce(F.col("declared") + end == F.col("rest"), F.lit(False)))
        .withColumn(
            "block",
            F.when(
                F.col("complete"),
                F.substring(
                    F.col("value").cast("binary"), (F.col("header_bytes") + end + 1).cast("int"), F.col("declared").cast("int")
                ),
            ),
        )
        .withColumn("skip", F.octet_length(F.substring_index(F.col("block").cast("string"), RECORD_END, 1)) + end)
        .withColumn("payload", F.substring("block", F.col("skip") + 1, F.octet_length("block")))
    )
    return described.withColumns(
        {
            "type": field("WARC-Type"),
            "id": field("WARC-Record-ID"),
            "refers_to": field("WARC-Refers-To"),
            "stated_digest": field("WARC-Payload-Digest"),
            "payload_bytes": F.octet_length("payload").cast("long"),
            "payload_digest": F.when(F.col("complete"), F.sha1("payload")),
        }
    ).drop("header", "block", "skip")


FACTS = ("type", "id", "refers_to", "stated_digest", "payload_bytes", "payload_digest")


def _reached(rows: DataFrame) -> DataFrame:
    """The candidates on the chain that starts at the first record of their file.

    Candidates that follow each other in a split are first drawn together: a
    segment runs from a head to the last row that the row before leads to, and is
    cut wherever another segment's exit lands. Pointers between segments are then
    doubled until no further head is reached; that takes the logarithm of the
    number of segments in a file, which is about that of its splits. A segment
    whose last row leads nowhere keeps its rows.
    """
    order = Window.partitionBy("file", "split").orderBy("turn")
    linked = written(
        rows.withColumns(
            {
                "led": F.coalesce(F.lag("next").over(order) == F.col("start"), F.lit(False)),
                "leads": F.coalesce(F.lead("start").over(order) == F.col("next"), F.lit(False)),
            }
        ),
        "candidates",
    )
    exits = written(
        linked.where("NOT leads AND next IS NOT NULL").select("file", F.col("next").alias("start")).distinct()
        .withColumn("landed", F.lit(True)),
        "exits",
    )
    headed = written(
        linked.join(exits, ["file", "start"], "left").withColumn(
            "head",
            F.last(F.when(~F.col("led") | F.col("landed"), F.col("start")), ignorenulls=True).over(
                order.rowsBetween(Window.unboundedPreceding, 0)
            ),
        ),
        "segments",
    )
    segments = written(
        headed.groupBy("file", "head").agg(F.max_by("next", "start").alias("to")), "pointers"
    )
    heads = segments.select("file", "head")
    first = headed.groupBy("file").agg(F.min("start").alias("head"))
    pointers, reached, count = segments, written(first, "reached"), 0
    while (now := reached.count()) > count:
        count = now
        step = reached.join(pointers, ["file", "head"]).select("file", F.col("to").alias("head"))
        reached = written(
            reached.union(step).distinct().join(heads, ["file", "head"], "left_semi"), "reached"
        )
        onward = pointers.select("file", F.col("head").alias("to"), F.col("to").alias("further"))
        pointers = written(
            pointers.join(onward, ["file", "to"]).select("file", "head", F.col("further").alias("to")), "pointers"
        )
    return headed.join(reached, ["file", "head"], "left_semi")


def _reassembled(spark: SparkSession, path: str, broken: DataFrame) -> DataFrame:
    """Records whose header or payload holds the magic, joined again from their pieces.

    Only the files that hold such records are read again. Pieces meet their record
    in buckets of offsets, so a file's records are spread over tasks.
    """
    bucket = 1 << 22
    files = written(broken.select("file").distinct(), "broken-files")
    pieces = _placed(_scan(spark, path).join(F.broadcast(files), "file", "left_semi"))
    spans = written(
        broken.select(
            "file",
            F.col("start").alias("record"),
            F.col("next").alias("stop"),
            F.explode(F.sequence(F.floor(F.col("start") / bucket), F.floor(F.col("next") / bucket))).alias("bucket"),
        ),
        "broken-records",
    )
    met = pieces.withColumn("bucket", F.floor((F.col("offset") - len(MAGIC)) / bucket)).join(spans, ["file", "bucket"])
    inside = met.where(f"offset - {len(MAGIC)} >= record AND offset < stop")
    whole = inside.groupBy("file", "record").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("offset", "value"))), lambda piece: piece.value), MAGIC
        ).alias("value")
    )
    return _described(whole)


def _next(start: Column) -> Column:
    return start + len(MAGIC) + F.col("header_bytes") + F.col("declared") + 2 * len(RECORD_END)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path``, whatever their headers and payloads hold.

    Every place with the magic at a file's start or after a record's end is a candidate whose
    header says where the next record starts; those that the chain from the file's first
    magic doesn't reach are parts of payloads. Returns ``id``, ``type``, ``refers_to``,
    ``payload_bytes`` and ``payload_digest`` (measured; for revisits those of the response they
    refer to, and the stated digest), as strings and longs. A revisit without its
    response has null bytes. Bytes before a file's first magic are skipped. Where a file is
    damaged or cut off its chain ends: all whole records before that place are
    returned, what stands after it is not.
    """
    rows = _placed(_described(_scan(spark, path)).drop("value", "payload"))
    found = written(
        _candidates(rows.withColumn("start", F.col("offset") - len(MAGIC))).withColumn("next", _next(F.col("start"))),
        "described",
    )
    cut = written(
        found.where("rest < 0 AND header_end IS NOT NULL").select("file", "split", "turn", "start", F.col("header_end").alias("next")),
        "cut-headers",
    )
    if not cut.isEmpty():
        joined = _reassembled(spark, path, cut.select("file", "start", "next")).select(
            "file", F.col("record").alias("start"), _next(F.col("record")).alias("next"), "complete", *FACTS
        )
        kept = ["file", "split", "turn", "start", "next", "complete", *FACTS]
        mended = cut.drop("next").join(joined, ["file", "start"]).select(kept)
        found = written(found.join(cut, ["file", "start"], "left_anti").select(kept).union(mended), "mended")
    real = written(_reached(found), "records")
    records = real.where("complete").select(*FACTS)
    broken = written(real.where("NOT complete AND next IS NOT NULL").select("file", "start", "next"), "broken")
    if not broken.isEmpty():
        records = written(
            records.union(_reassembled(spark, path, broken).where("complete").select(*FACTS)), "records"
        )
    responses = written(
        records.where("type <> 'revisit' AND id IS NOT NULL")
        .groupBy(F.col("id").alias("response"), F.col("payload_digest").alias("digest"))
        .agg(F.max("payload_bytes").alias("bytes")),
        "responses",
    )
    revisits = records.where("type = 'revisit'").join(
        responses,
        (F.col("refers_to") == F.col("response")) & (F.col("stated_digest") == F.col("digest")),
        "left",
    )
    return records.where("type <> 'revisit'").select(
        "id", "type", F.lit(None).cast("string").alias("refers_to"), "payload_bytes", "payload_digest"
    ).union(
        revisits.select(
            "id", "type", "refers_to", F.col("bytes").alias("payload_bytes"), F.col("stated_digest").alias("payload_digest")
        )
    )


def archived(pages: DataFrame) -> DataFrame:
    """Writes pages to new archives in the shared folder and reads them back."""
    spark = pages.sparkSession
    path = new_path(spark, "archives")
    write_archives(with_record_types(pages), path)
    return read_archives(spark, path)
