"""Mixing sources to target weights.

Words are summed per source, every source gets its share of the total by
weight, bounded by a multiple of what it has, and the repetition rate
``target / source size`` decides how often each of its documents is emitted:
``floor(rate)`` times, plus one copy with the fraction as its probability.
The coin is a hash of the document id and a seed, so reruns agree and no state
crosses tasks.

Defined cases: a null text has size 0; a null source is a source of its own,
ordered last; a source without words has target 0 and its documents are not
taken; rows that repeat a doc_id share their coin; an empty table gives no
rows; columns other than ``doc_id``, ``text`` and ``source`` pass through
``mix`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lading.llm.common import n_words, packed, same, small, staged

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = "mix-1"


def source_targets(sized: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``.

    Weights go to the sources in code point order, null last, and repeat.  All
    targets together are 100 % of all sizes; what a source may not take above
    ``max_repeat`` times its size is reshared by weight until none is above.
    That fixed point is found in one sorted pass: with sources in the order of
    ``cap / weight`` the bounded ones are a prefix.  All sums are integers.

    The windows run over one row per source, not over documents.
    """
    big = "decimal(38,0)"
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    per = (sized.groupBy("source").agg(F.sum("size").alias("source_size"))
           .withColumn("w", weight.cast(big))
           .withColumn("cap", (F.col("source_size") * max_repeat).cast(big)))
    # cap / w as doubles only orders the rows; ties fall back to the name
    by_cap = Window.orderBy((F.col("cap") / F.col("w")).cast("double"), F.col("source").asc_nulls_last())
    upto = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = (per.withColumn("rest", F.sum(F.col("source_size")).over(whole).cast(big)
                          - F.coalesce(F.sum("cap").over(upto), F.lit(0)).cast(big))
           .withColumn("rest_w", F.sum("w").over(onward).cast(big))
           .withColumn("at", F.row_number().over(by_cap))
           .withColumn("free", F.col("rest") * F.col("w") <= F.col("cap") * F.col("rest_w")))
    first = F.min(F.when(F.col("free"), F.struct("at", "rest", "rest_w"))).over(whole)
    per = per.withColumn("fill", first)
    level = F.col("fill.rest") * F.col("w")
    bounded = F.col("fill").isNull() | (level > F.col("cap") * F.col("fill.rest_w"))
    return per.select("source", F.col("source_size").cast("long").alias("source_size"),
                      F.when(bounded, F.col("cap").cast("double"))
                      .otherwise(level.cast("double") / F.col("fill.rest_w").cast("double")).alias("target"))


def coin(doc_id: Column, seed: str = SEED) -> Column:
    """A uniform number in [0, 1) from 52 bits of the id's hash."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def copies(rate: Column, doc_id: Column, seed: str = SEED) -> Column:
    """``floor(rate)`` plus a Bernoulli copy for the fraction; 0 where there is no rate."""
    whole = F.floor(rate)
    return F.coalesce(whole + (coin(doc_id, seed) < rate - whole).cast("long"), F.lit(0).cast("long"))


def mixing_plan(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT,
                seed: str = SEED) -> DataFrame:
    """``docs`` plus ``size, source_size, target, copies``.

    One narrow aggregate (combined before its shuffle, so a hot source is a
    few rows per task); documents then meet their source's row in a broadcast
    if there are few sources, and are not shuffled.  Columns of ``docs`` with
    these names are replaced.
    """
    docs = docs.drop("size", "source_size", "target", "copies")
    sized = docs.select("source", n_words(F.col("text")).alias("size"))
    targets = small(staged(source_targets(sized, weights, max_repeat), "mix-targets")
                    .withColumnRenamed("source", "_source"))
    rate = F.try_divide(F.col("target"), F.col("source_size"))
    return (docs.withColumn("size", n_words(F.col("text")))
            .join(targets, same(F.col("source"), F.col("_source")), "left").drop("_source")
            .withColumn("copies", copies(rate, F.col("doc_id"), seed)))


def mix(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """The mixture: every document as often as its source's rate says, columns of ``docs``."""
    plan = mixing_plan(packed(docs, "doc_id", "text", "source"), weights, max_repeat, seed)
    return (plan.where("copies > 0").select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("_row.*"))
