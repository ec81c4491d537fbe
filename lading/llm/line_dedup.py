"""Line dedup by distinct-site spread.

Every line's sites go into a HyperLogLog sketch by line hash; sketches merge in
the aggregation, so a line that is everywhere is one small row per task.  Lines
whose estimate is near the threshold are counted exactly.  Lines on at least
``MIN_SITES`` sites are boilerplate and leave every document.

Documents are cut where they lie: the boilerplate lines' hashes, up to
``BROADCAST_KEYS`` of them, go to every task, and no text is shuffled.  Should
there be more, documents meet their lines' places in a join instead, with the
same result.

Lines are compared without surrounding white space, by a 64-bit hash; blank
lines are never boilerplate and stay.

Defined cases: a null text has no lines and stays null; an empty text has one
blank line; a null source is a site of its own; a document whose lines all go
keeps an empty text; rows that repeat a doc_id are cut each by their own text;
an empty table gives no rows; other columns pass through ``remove_boilerplate``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lading.llm.common import packed, same, small, spark_of, staged

MIN_SITES = 10
#: size of the sketches (2^10 registers: about 3 % error) and the band that is counted exactly
LG_K = 10
NEAR = 0.25

#: at most this many line hashes are broadcast (one sorted array, 8 bytes each)
BROADCAST_KEYS = 2_000_000

BLANKS = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, tkey, site, at, key`` of every line that is not blank."""
    return (docs.select("doc_id", F.xxhash64("text").alias("tkey"),
                        F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), "source")).alias("site"),
                        F.posexplode(lines_of(F.col("text"))).alias("at", "line"))
            .withColumn("line", F.btrim("line", F.lit(BLANKS))).where("line <> ''")
            .select("doc_id", "tkey", "site", "at", F.xxhash64("line").alias("key")))


def boilerplate(rows: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``key`` of the lines on at least ``min_sites`` sites."""
    spread = staged(rows.groupBy("key").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("sites"))
                    .where(F.col("sites") >= min_sites * (1 - NEAR)), "line-spread")
    clear = spread.where(F.col("sites") > min_sites * (1 + NEAR)).select("key")
    near = spread.where(F.col("sites") <= min_sites * (1 + NEAR)).select("key")
    exact = (rows.select("key", "site").join(small(near), "key", "left_semi").distinct()
             .groupBy("key").count().where(F.col("count") >= min_sites).select("key"))
    return staged(clear.union(exact), "line-boilerplate")


def line_keys(text: Column) -> Column:
    """The hash of every line of a text, by place."""
    return F.transform(lines_of(text), lambda x: F.xxhash64(F.btrim(x, F.lit(BLANKS))))


def _cutter(shared):
    """Texts and their line hashes to the text without boilerplate and the number of lines cut.

    ``shared`` holds the boilerplate's hashes in order.
    """
    @F.pandas_udf("text string, n_removed long")
    def cut(text: pd.Series, keys: pd.Series) -> pd.DataFrame:
        gone, out, begin = shared.value, [], 0
        lines = [np.zeros(0, np.int64) if k is None else np.asarray(k, np.int64) for k in keys]
        every = np.concatenate([*lines, np.zeros(0, np.int64)])
        at = np.searchsorted(gone, every)
        at[at == len(gone)] = 0
        bad = gone[at] == every if len(gone) else np.zeros(len(every), bool)
        for t, k in zip(text, lines):
            cuts, begin = bad[begin:begin + len(k)], begin + len(k)
            n = int(cuts.sum())
            out.append((t if not n else "\n".join(x for x, b in zip(t.split("\n"), cuts.tolist()) if not b), n))
        return pd.DataFrame(out, columns=["text", "n_removed"])

    return cut


def boilerplate_places(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``_id, _tkey, places``: the boilerplate lines of the documents that have some."""
    hits = line_rows(docs).join(keys, "key", "left_semi")
    return staged(hits.groupBy(F.col("doc_id").alias("_id"), F.col("tkey").alias("_tkey"))
                  .agg(F.collect_set("at").alias("places")), "line-places")


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """``docs`` with boilerplate lines cut from ``text``, plus ``n_lines, n_removed``."""
    keys = boilerplate(line_rows(docs), min_sites)
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    n_lines = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines_of(F.col("text"))))
    if keys.count() <= broadcast_keys:
        shared = spark_of(docs).sparkContext.broadcast(np.sort(keys.toArrow().column("key").to_numpy()))
        cut = packed(docs, "text").select("_row", n_lines.alias("n"), _cutter(shared)("text", line_keys(F.col("text"))).alias("cut"))
        return cut.select(*[F.col("cut.text").alias(c) if c == "text" else F.col(f"_row.`{c}`") for c in columns],
                          F.col("n").cast("long").alias("n_lines"), F.col("cut.n_removed").alias("n_removed"))
    places = boilerplate_places(docs, keys)
    kept = F.array_join(F.filter(lines_of(F.col("text")), lambda x, i: ~F.array_contains(F.col("places"), i)), "\n")
    on = same(F.col("doc_id"), F.col("_id")) & (F.xxhash64("text") == F.col("_tkey"))
    n_removed = F.when(F.col("places").isNull(), F.lit(0)).otherwise(F.size("places"))
    text = F.when(F.col("places").isNull(), F.col("text")).otherwise(kept)
    return (packed(docs, "doc_id", "text").join(places, on, "left")
            .select(*[text.alias(c) if c == "text" else F.col(f"_row.`{c}`") for c in columns],
                    n_lines.cast("long").alias("n_lines"), n_removed.cast("long").alias("n_removed")))
