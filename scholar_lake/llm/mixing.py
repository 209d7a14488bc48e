"""Mixing sources to target weights: repetition rates per source, whole repeats plus one hash-seeded Bernoulli copy.

Only built-in functions. The documents are read twice (sizes of the sources, then the rows); what moves between machines is one
partial sum per task and source, and the table of sources, which has one row per source.

Defined results: null text has size 0; null is a source of its own and comes last; sources of size 0 get target 0 and no copies; an
empty table gives an empty table; equal rows are equal draws (the draw depends on seed and doc_id alone); input columns that bear the
name of a computed one are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from scholar_lake.llm.common import word_count


def source_targets(sizes: DataFrame, source: str = "source", size: str = "size", weights: Sequence[int] = (3, 1, 2),
                   share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source: ``mix_source``, ``mix_size``, ``mix_target``.

    Sources in code point order, null last, take the weights in turn and share ``share`` times all sizes. A target stops at ``most``
    times its source's size; the excess goes to the others by weight until none is above. That fixed point is
    min(most * size, level * weight), where the level is the largest of (total - capped before k) / (weights from k on) over the
    sources in the order of their size per weight, so no iteration is needed.
    """
    by_source = sizes.groupBy(F.col(source).alias("mix_source")).agg(F.sum(size).alias("mix_size"))
    rank = F.row_number().over(Window.orderBy(F.col("mix_source").asc_nulls_last())) - 1
    taking = F.array(*[F.lit(int(w)) for w in weights])
    ranked = (by_source.withColumn("mix_rank", rank)
              .withColumn("mix_weight", F.get(taking, F.col("mix_rank") % len(weights)).cast("long")))
    by_room = Window.orderBy(F.col("mix_size") / F.col("mix_weight"), "mix_rank")
    before = F.sum("mix_size").over(by_room.rowsBetween(Window.unboundedPreceding, -1))
    left = F.sum("mix_weight").over(by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    everything = Window.partitionBy()
    total = F.sum("mix_size").over(everything)
    level = (F.lit(float(share)) * total - F.lit(float(most)) * F.coalesce(before, F.lit(0))) / left
    leveled = ranked.withColumn("mix_level", level).withColumn("mix_level", F.max("mix_level").over(everything))
    target = F.least(F.lit(float(most)) * F.col("mix_size"), F.col("mix_level") * F.col("mix_weight"))
    return leveled.select("mix_source", "mix_size", target.cast("double").alias("mix_target"))


def draw(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone: 52 bits of an MD5 sum."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("null")))), 1, 13)
    return F.conv(digits, 16, 10).cast("long").cast("double") / F.lit(float(16 ** 13))


def plan_mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
             seed: str = "mix") -> DataFrame:
    """docs with ``size``, ``source_size``, ``target`` (its source's) and ``copies``, the times the mix emits the document."""
    sized = docs.withColumn("size", word_count(F.col("text")))
    targets = source_targets(sized.select("source", "size"), weights=weights, share=share, most=most)
    rate = F.when(F.col("mix_size") > 0, F.col("mix_target") / F.col("mix_size")).otherwise(0.0)
    whole = F.floor(rate)
    copies = (whole + (draw(F.col("doc_id"), seed) < rate - whole).cast("long")).cast("int")
    mixed = sized.join(targets, F.col("source").eqNullSafe(F.col("mix_source")), "left")
    return (mixed.withColumn("source_size", F.col("mix_size")).withColumn("target", F.col("mix_target"))
            .withColumn("copies", copies).drop("mix_source", "mix_size", "mix_target"))


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: each document as often as planned, with the columns of docs."""
    planned = plan_mix(docs.withColumn("mix_row", F.struct(*[F.col(f"`{c}`") for c in docs.columns])), **settings)
    return planned.select("mix_row", F.explode(F.array_repeat(F.lit(True), F.col("copies")))).select("mix_row.*")
