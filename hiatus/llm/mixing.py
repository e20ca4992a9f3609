"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hiatus.llm.tables import fresh, text_bytes, written
from hiatus.operators.ordering import totals_before

SEED = 17
#: Steps of the inverted distribution at most for a rate of 1; the bound grows
#: with the rate and leaves a probability far below that of one hash value.
_TAIL_SIGMAS, _TAIL_STEPS = 12, 24
LARGEST_RATE = 500


def unit_hash(*parts: Column) -> Column:
    """A number in [0, 1) from 48 bits of the MD5 of the parts; nulls count as one value."""
    digits = F.conv(F.substring(F.md5(_joined(*parts)), 1, 12), 16, 10).cast("double")
    return (digits + 0.5) / float(1 << 48)


def _joined(*parts: Column) -> Column:
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("\\N")) for p in parts])


def poisson(rate: Column, unit: Column) -> Column:
    """The Poisson distribution's inverse at ``unit``, for rates up to ``LARGEST_RATE``.

    Counts the values k whose cumulative probability lies below ``unit``.
    """
    steps = F.ceil(rate + _TAIL_SIGMAS * F.sqrt(rate) + _TAIL_STEPS).cast("int")
    start = F.struct(
        F.exp(-rate).alias("p"), F.exp(-rate).alias("total"), F.lit(0).cast("long").alias("n")
    )

    def step(state: Column, k: Column) -> Column:
        p = state.p * rate / k
        return F.struct(
            p.alias("p"),
            (state.total + p).alias("total"),
            F.when(unit > state.total, k.cast("long")).otherwise(state.n).alias("n"),
        )

    return F.aggregate(F.sequence(F.lit(1), steps), start, step, lambda state: state.n)


def copies(rate: Column, *key: Column) -> Column:
    """How often the row of a key appears, by a Poisson distribution with the rate.

    A rate beyond ``LARGEST_RATE``, where the first probability would vanish, is the sum of
    equal parts with a hash each, so mean and variance stay those of the rate.
    """
    parts = F.greatest(F.ceil(rate / LARGEST_RATE), F.lit(1)).cast("int")
    return F.aggregate(
        F.sequence(F.lit(0), parts - 1),
        F.lit(0).cast("long"),
        lambda total, part: total + poisson(rate / parts, unit_hash(*key, part)),
    )


def source_rates(
    documents: DataFrame,
    weights: Mapping[str, float] | None = None,
    source: str = "source",
    text: str = "text",
    size: float = 1.0,
) -> DataFrame:
    """(source, rate): how often each document of a source is to appear on average.

    The mixture has ``size`` times the documents' bytes, of which a source gets
    its share of the weights. Without weights all sources get the same share;
    with them, sources that are not named get none. Sources without any bytes
    are as likely as the others to be copied.
    """
    totals = documents.groupBy(F.col(source).alias("source")).agg(
        F.sum(F.coalesce(F.octet_length(text), F.lit(0)).cast("long")).alias("n_bytes")
    )
    if weights is None:
        weight = F.lit(1.0)
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    weighted = written(totals.withColumn("weight", weight), "sources")
    total = weighted.agg(F.sum("n_bytes"), F.sum(F.when(F.col("n_bytes") > 0, F.col("weight")))).first()
    wanted = float(total[0] or 0) * size
    share = F.col("weight") / F.lit(float(total[1] or 1.0))
    rate = F.when(F.col("n_bytes") > 0, share * F.lit(wanted) / F.col("n_bytes")).otherwise(
        F.when(F.col("weight") > 0, F.lit(float(size))).otherwise(0.0)
    )
    return written(weighted.select("source", rate.alias("rate")), "rates")


def mix(
    documents: DataFrame,
    weights: Mapping[str, float] | None = None,
    ident: str = "doc_id",
    source: str = "source",
    text: str = "text",
    size: float = 1.0,
    seed: int = SEED,
) -> DataFrame:
    """Documents repeated to the target weights, in a random global order.

    Each row appears as often as a Poisson distribution with its source's rate has it,
    inverted at a hash of seed, id, the text's MD5 and the row's number among those that
    share both, so that a rerun gives the same copies. Adds ``copy`` (from 0) and ``mix_key``
    (the global order; rows are dealt to partitions by its hash and sorted inside
    them), replacing such columns.

    A null source is a source of its own. Null ids and ids that repeat are told apart by
    text and number, so every row has a draw and a place of its own. Null texts are
    empty and have no bytes. Rows alike in id and text are numbered by a hash of their other
    columns; those alike in all are dealt freely. No rows give no rows.
    """
    base = documents.drop(*[c for c in ("copy", "mix_key") if c not in (ident, source, text)])
    rates = source_rates(base, weights, source, text, size)
    rate, name, count, digest, number = (fresh(base, c) for c in ("_rate", "_source", "_copies", "_digest", "_number"))
    rated = _numbered(base.withColumn(digest, F.md5(text_bytes(text))), ident, digest, number).join(
        rates.select(F.col("source").alias(name), F.col("rate").alias(rate)),
        F.col(source).eqNullSafe(F.col(name)),
    )
    key = (F.col(ident), F.col(digest), F.col(number))
    drawn = rated.withColumn(count, copies(F.col(rate), F.lit(seed), *key)).where(F.col(count) > 0)
    repeated = drawn.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1)))
    keyed = repeated.withColumn("mix_key", F.md5(_joined(F.lit(seed), F.lit("order"), *key, F.col("copy"))))
    return keyed.select(*base.columns, "copy", "mix_key").repartition("mix_key").sortWithinPartitions("mix_key")


def _numbered(rows: DataFrame, ident: str, digest: str, number: str) -> DataFrame:
    """Adds the number, from 0, of each row among those with the same id and digest.

    Only rows of pairs that occur twice are dealt anew, by ranges that may split the
    rows of one pair, however many it has.
    """
    one, other, first, turn, place = (fresh(rows, c) for c in ("_id", "_text", "_first", "_turn", "_place"))
    pairs = written(
        rows.groupBy(F.col(ident).alias(one), F.col(digest).alias(other)).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n"),
        "repeated-rows",
    )
    if pairs.isEmpty():
        return rows.withColumn(number, F.lit(0).cast("long"))
    same = F.col(ident).eqNullSafe(F.col(one)) & (F.col(digest) == F.col(other))
    alike = [f.name for f in rows.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    several = rows.join(pairs, same, "left_semi").withColumn(turn, F.monotonically_increasing_id())
    order = [F.asc_nulls_first(ident), F.asc(digest), F.xxhash64(*alike), F.asc(turn)]
    placed = written(
        totals_before(several, order, {place: F.lit(1).cast("long")}, store=lambda frame: written(frame, "dealt-rows")),
        "placed-rows",
    )
    starts = placed.groupBy(F.col(ident).alias(one), F.col(digest).alias(other)).agg(F.min(place).alias(first))
    numbered = placed.join(starts, same).withColumn(number, F.col(place) - F.col(first))
    once = rows.join(pairs, same, "left_anti").withColumn(number, F.lit(0).cast("long"))
    return once.unionByName(numbered.select(*once.columns))
