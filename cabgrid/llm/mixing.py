"""Mixing sources to target weights by capped water-filling, in DataFrame operations only.

Targets: every source gets its share of the total by weight, but no more than
``max_epochs`` times its size; what is cut off is shared among the others by
weight until no source is above its cap. Sampling: whole repetitions of every
document, and one more of those whose seeded position lies below the fraction
that is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cabgrid.llm.common import WORD, checkpointed, raw_text, unused

#: Seeded positions fall into so many ranges per source; only one of them is sorted.
RANGES = 1 << 16
#: Targets of so many sources (some 100 bytes each) may be broadcast.
FEW_SOURCES = 10_000


def words_of(text_col: str = "text") -> Column:
    """Number of words of a text; null: none."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def _digest(text_col: str) -> Column:
    """Tells texts of one id apart."""
    return F.xxhash64(raw_text(text_col))


def water_fill(sources: DataFrame, total_share: float, max_epochs: float) -> DataFrame:
    """Adds ``target`` to ``sources`` (``source``, ``weight``, ``source_size``).

    Every round spreads the total, less what capped sources hold, over the
    weights of the others and caps those that then lie above their cap; three
    sums a round reach the driver. Sources of size or weight zero get zero.
    """
    total = total_share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    cap = F.lit(float(max_epochs)) * F.col("source_size")
    above, fill, capped = F.lit(False), F.lit(0.0), -1
    while True:
        size, weight, n = sources.agg(
            F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
            F.count(F.when(above, 1)),
        ).first()
        if n == capped or not weight:
            return sources.withColumn("target", F.when(above, cap).otherwise(fill))
        capped = n
        fill = F.col("weight") * F.lit(float(total - max_epochs * size)) / F.lit(float(weight))
        above = fill >= cap


def mix(
    docs: DataFrame,
    weights: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    total_share: float = 1.5,
    max_epochs: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``source``, ``digest``, ``size``, ``source_size``, ``target``, ``times`` and ``taken``.

    ``weights`` has one row (``source``, ``weight`` >= 0) per source, null
    included; a source without one weighs nothing. A document is taken
    ``times`` whole times: as often as its target holds the whole source, and
    once more if its position, a hash of seed and id (of the text where there is
    no id), comes before the point
    where the words up to it reach the fraction left; so the words taken from
    a source miss its target by half a document at most. The point is found
    from sums over ranges of positions; only documents of the one range per
    source that holds it are sorted.

    A null or empty text has size 0 and is taken as often as its neighbours;
    rows that repeat an id share one position, ties in order of size, then
    digest; an empty table gives an empty result. The targets, a row per
    source, are broadcast for at most ``FEW_SOURCES`` sources, counted first.
    """
    no_id = F.concat(F.lit("null:"), F.md5(raw_text(text_col)))
    at = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), no_id)))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        _digest(text_col).alias("digest"),
        words_of(text_col).alias("size"),
        F.conv(F.substring(at, 1, 4), 16, 10).cast("int").alias("part"),
        F.substring(at, 5, 28).alias("place"),
    )
    rows = checkpointed(rows)
    parts = rows.groupBy("source", "part").agg(F.sum("size").alias("words"))
    sources = parts.groupBy("source").agg(F.sum("words").alias("source_size"))
    weighed = sources.join(
        weights.select(F.col("source").alias("s"), "weight"), F.col("source").eqNullSafe(F.col("s")), "left"
    ).select("source", "source_size", F.coalesce("weight", F.lit(0)).alias("weight"))
    plan = checkpointed(water_fill(checkpointed(weighed), total_share, max_epochs))
    size = F.col("source_size")
    whole = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("long")
    plan = plan.select(
        F.col("source").alias("s"), "source_size", "target", whole.alias("whole"), (F.col("target") - whole * size).alias("rest")
    )
    same = F.col("source").eqNullSafe(F.col("s"))
    before = F.sum("words").over(W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    parts = parts.withColumn("before", F.coalesce(before, F.lit(0))).join(plan.select("s", "rest"), same)
    point = parts.where("before + words > rest AND before <= rest").select("s", F.col("part").alias("cut"), "before")
    plan = plan.join(
        point.select(F.col("s").alias("p"), "cut", "before"), F.col("s").eqNullSafe(F.col("p")), "left"
    ).drop("p")
    plan = checkpointed(plan)
    rows = rows.join(F.broadcast(plan) if plan.count() <= FEW_SOURCES else plan, same).drop("s")
    out = [F.col("id").alias(id_col), "source", "digest", "size", "source_size", "target", "times"]
    edge = F.sum("size").over(W.partitionBy("source").orderBy("place", "size", "digest").rowsBetween(W.unboundedPreceding, -1))
    inner = (
        rows.where("part = cut")
        .withColumn("start", F.col("before") + F.coalesce(edge, F.lit(0)))
        .withColumn("times", F.col("whole") + ((F.col("rest") > 0) & (F.col("start") + F.col("size") / 2 <= F.col("rest"))).cast("long"))
    )
    outer = rows.where("cut IS NULL OR part <> cut").withColumn(
        "times", F.col("whole") + F.expr("CAST(coalesce(rest > 0 AND part < cut, false) AS long)")
    )
    return (
        inner.select(*out)
        .unionByName(outer.select(*out))
        .withColumn("taken", F.col("size") * F.col("times"))
    )


def cycled_weights(docs: DataFrame, cycle: list[int], source_col: str = "source") -> DataFrame:
    """``source``, ``weight``: the sources in code point order, null last, weigh the values of ``cycle`` in turn.

    The rows sorted here are one per source.
    """
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    sources = docs.select(F.col(source_col).alias("source")).distinct()
    return sources.select("source", F.element_at(F.array(*map(F.lit, cycle)), (place % len(cycle) + 1).cast("int")).alias("weight"))


def repeated(
    docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """``docs`` with each row as many times as ``mixed`` (the result of ``mix`` over it) says.

    Rows are told apart by source, id and text. Rows that share all three
    have the times of all of them dealt out evenly, the odd ones to some.
    """
    names = unused(docs, "mix_id", "mix_source", "mix_digest", "mix_times", "mix_rows", "own_digest", "mix_nth", "mix_copy")
    of_id, of_source, of_digest, times, n_rows, own, nth, copy = names
    sums = mixed.groupBy(F.col(id_col).alias(of_id), F.col("source").alias(of_source), F.col("digest").alias(of_digest)).agg(
        F.sum("times").alias(times), F.count(F.lit(1)).alias(n_rows)
    )
    sums = checkpointed(sums.where(F.col(times) > 0))
    same = F.col(id_col).eqNullSafe(F.col(of_id)) & F.col(source_col).eqNullSafe(F.col(of_source)) & (F.col(own) == F.col(of_digest))
    rows = docs.withColumn(own, _digest(text_col))
    each, odd = F.floor(F.col(times) / F.col(n_rows)), F.col(times) % F.col(n_rows)
    out = rows.join(sums.where(odd == 0), same).withColumn(copy, each)
    uneven = sums.where(odd > 0)  # one a source at most: equal rows at the point where its last round ends
    n_uneven = uneven.count()
    if n_uneven:
        number = F.row_number().over(W.partitionBy(of_id, of_source, of_digest).orderBy(F.lit(0)))
        some = rows.join(F.broadcast(uneven) if n_uneven <= FEW_SOURCES else uneven, same).withColumn(nth, number)
        out = out.unionByName(some.withColumn(copy, each + (F.col(nth) <= odd).cast("long")).drop(nth).where(F.col(copy) > 0))
    return out.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copy).cast("int")))).select(docs.columns)
