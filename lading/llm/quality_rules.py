"""Quality rules: base rules, and robust multivariate outliers of text statistics.

Every text is reduced to a few counts; base rules reject on these directly.
The rest are vectors of transformed statistics, judged against the minimum-
covariance-determinant estimate of their language and source: the centre and
covariance of the share of rows that lie closest together, found by
concentration steps from a start at the medians.  A row is rejected when its
Mahalanobis distance is beyond the cutoff.

Each concentration step is two aggregations over narrow rows: a histogram of
distances gives the group's cut, then moments of the rows inside it are summed.
Vectors are whole numbers of 1/1024, so sums do not depend on their order and
reruns agree; a hot group is summed in every task before its rows meet.  A
group with fewer than ``MIN_GROUP`` rows is judged by its language's estimate,
and a language with fewer by that of all rows.  Variances have a floor, so a
statistic that is the same in nearly all texts rejects nothing by a hair, and
distances of short texts, whose rates vary by chance, count less.

Defined cases: null and wordless texts have zero counts and fail the base
rules; base-failed rows take no part in the estimates; null languages and
sources are groups of their own; rows that repeat a doc_id are judged each; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lading.llm.common import small, staged

MIN_WORDS = 10
REPEAT_WORDS = 5
MAX_REPEAT_PERCENT = 20

#: share of a group's rows that the estimate covers, and steps towards them
COVER = 0.75
STEPS = 5
MIN_GROUP = 100
#: rows are rejected beyond this chi-square tail
TAIL = 1e-8
#: words at which a text's distance counts half
HALF_WORDS = 20
UNIT = 1024
#: histogram bins per doubling of the distance
BINS = 32

#: statistic -> (SQL over the counts, floor of its standard deviation)
STATS = {
    "length": ("ln(word_chars / n_words)", 0.08),
    "symbols": ("sqrt(n_symbols / word_chars)", 0.05),
    "signs": ("sqrt(n_signs / word_chars)", 0.05),
    "capitals": ("sqrt(n_capitals / word_chars)", 0.05),
    "dup_lines": ("sqrt(n_dup_lines / n_lines)", 0.10),
    "repeats": ("sqrt(n_repeat_words / n_words)", 0.10),
}
NAMES = list(STATS)
P = len(NAMES)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_signs", "n_capitals", "n_lines", "n_dup_lines", "n_repeat_words")

SYMBOLS = b"#*$%&|<>"
#: ASCII signs other than letters, digits and white space
SIGNS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_counts(text: str | None) -> tuple[int, ...]:
    """``COUNTS`` of a text."""
    from xxhash import xxh3_64_intdigest

    raw = (text or "").encode("utf-8")
    words = raw.split()
    n = len(words)
    if not n:
        return (0,) * len(COUNTS)
    solid = b"".join(words)
    marks = np.bincount(np.frombuffer(solid, np.uint8), minlength=256)
    chars = int(marks[:0x80].sum() + marks[0xC0:].sum())  # bytes that begin a code point
    lines = [x for x in raw.split(b"\n") if x.split()]
    covered = 0
    if n > REPEAT_WORDS:
        w = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, n)
        h = np.zeros(n - REPEAT_WORDS + 1, np.uint64)
        for j in range(REPEAT_WORDS):
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + w[j:n - REPEAT_WORDS + 1 + j]
        _, which, count = np.unique(h, return_inverse=True, return_counts=True)
        at = np.flatnonzero(count[which] > 1)
        if len(at):
            step = np.zeros(n + 1, np.int64)
            step[at] += 1
            step[at + REPEAT_WORDS] -= 1
            covered = int((np.cumsum(step[:-1]) > 0).sum())
    return (n, chars, int(marks[list(SYMBOLS)].sum()), int(marks[list(SIGNS)].sum()), int(marks[list(CAPITALS)].sum()),
            len(lines), len(lines) - len(set(lines)), covered)


def _count_partition(batches):
    import pyarrow as pa

    for b in batches:
        found = [text_counts(t) for t in b.column(3).to_pylist()]
        columns = list(zip(*found)) if found else [[]] * len(COUNTS)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), *(pa.array(c, pa.int64()) for c in columns)],
                                         names=["doc_id", "lang", "source", *COUNTS])


def base_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source``, the counts and ``base_failed`` of every row."""
    found = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", "text")
             .mapInArrow(_count_partition, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return found.withColumn("base_failed", failed)


def chi2_quantile(tail: float, dof: int) -> float:
    """Upper quantile of chi-square, by bisection on its distribution (series of the incomplete gamma)."""
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, dof) < 1 - tail else (lo, mid)
    return hi


def chi2_cdf(x: float, dof: int) -> float:
    if x <= 0:
        return 0.0
    a, h = dof / 2, x / 2
    term = total = 1 / a
    i = 1
    while term > total * 1e-17 and i < 100_000:
        term *= h / (a + i)
        total += term
        i += 1
    return min(1.0, total * math.exp(a * math.log(h) - h - math.lgamma(a)))


def _group(lang: Column | None = None, source: Column | None = None) -> Column:
    """A group's key; null parts stay apart from every text."""
    part = lambda c: F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), c))
    return F.concat_ws("\x1f", *[part(c) for c in (lang, source) if c is not None]) if lang is not None else F.lit("")


def vectors(counts: DataFrame) -> DataFrame:
    """Counts of rows that pass the base rules plus their vector ``x`` and the group ``judge`` they are judged by."""
    good = counts.where("NOT base_failed")
    exact, lang = _group(F.col("lang"), F.col("source")), _group(F.col("lang"))
    sizes = good.groupBy("lang", "source").count()
    by_lang = Window.partitionBy("lang")
    named = small(staged(sizes.withColumn("in_lang", F.sum("count").over(by_lang))
                         .select(F.col("lang").alias("_l"), F.col("source").alias("_s"),
                                 F.when(F.col("count") >= MIN_GROUP, exact).when(F.col("in_lang") >= MIN_GROUP, lang)
                                 .otherwise(F.lit("")).alias("judge")), "rule-groups"))
    x = F.array(*[F.round(F.expr(sql) * UNIT).cast("long") for sql, _ in STATS.values()])
    return (good.join(named, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")))
            .drop("_l", "_s").withColumn("x", x))


def _distance() -> Column:
    """Squared Mahalanobis distance of ``x`` from ``centre`` under ``inverse`` (row-major)."""
    d = [F.col("x")[i] - F.col("centre")[i] for i in range(P)]
    return sum((d[i] * d[j] * F.col("inverse")[i * P + j] * (1 if i == j else 2) for i in range(P) for j in range(i, P)), F.lit(0.0))


def _invert(frames):
    """Moments of each group to its centre and the inverse of its covariance."""
    import pandas as pd

    floor = np.diag([(UNIT * STATS[s][1]) ** 2 for s in NAMES])
    scale = COVER / chi2_cdf(chi2_quantile(1 - COVER, P), P + 2)  # makes the covered rows' covariance consistent
    for f in frames:
        out = []
        for g, n, s, q in zip(f["g"], f["n"], f["s"], f["q"]):
            centre = np.array(s, float) / n
            cov = np.array(q, float).reshape(P, P) / n - np.outer(centre, centre)
            out.append((g, centre.tolist(), np.linalg.inv(scale * cov + floor).ravel().tolist()))
        yield pd.DataFrame(out, columns=["g", "centre", "inverse"])


def estimates(rows: DataFrame) -> DataFrame:
    """``g, centre, inverse``: the robust estimate of every group of rows ``g, x``."""
    parts = [F.col("x")[i] for i in range(P)]
    quart = rows.groupBy("g").agg(*[F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}")
                                    for i, c in enumerate(parts)])
    spread = [F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, 2) + (UNIT * STATS[s][1]) ** 2 for i, s in enumerate(NAMES)]
    now = quart.select("g", F.array(*[F.col(f"q{i}")[1] for i in range(P)]).alias("centre"),
                       F.array(*[1 / spread[i] if i == j else F.lit(0.0) for i in range(P) for j in range(P)]).alias("inverse"))
    for _ in range(STEPS):
        now = staged(now, "rule-estimates")
        placed = rows.join(small(now), "g").withColumn(
            "bin", F.floor(F.log2(F.greatest(_distance(), F.lit(2.0 ** -20))) * BINS).cast("int"))
        upto = Window.partitionBy("g").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        whole = Window.partitionBy("g")
        cut = (placed.groupBy("g", "bin").count()
               .withColumn("before", F.coalesce(F.sum("count").over(upto), F.lit(0)))
               .withColumn("all", F.sum("count").over(whole))
               .where(F.col("before") < F.col("all") * COVER).groupBy("g").agg(F.max("bin").alias("cut")))
        inside = placed.select("g", "x", "bin").join(small(staged(cut, "rule-cuts")), "g").where("bin <= cut")
        moments = inside.groupBy("g").agg(
            F.count(F.lit(1)).alias("n"), F.array(*[F.sum(c) for c in parts]).alias("s"),
            F.array(*[F.sum(parts[min(i, j)] * parts[max(i, j)]) for i in range(P) for j in range(P)]).alias("q"))
        now = moments.mapInPandas(_invert, "g string, centre array<double>, inverse array<double>")
    return staged(now, "rule-estimates")


def quality_rules(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, the counts, ``base_failed``, ``distance`` and ``kept``."""
    counts = staged(base_counts(docs), "rule-counts")
    rows = staged(vectors(counts), "rule-vectors")
    # every group that judges some row is estimated on all rows of its language, or on all
    judges = rows.select("judge").distinct()
    levels = rows.select("x", F.explode(F.array_distinct(F.array(
        _group(F.col("lang"), F.col("source")), _group(F.col("lang")), F.lit("")))).alias("g"))
    known = estimates(staged(levels.join(small(staged(judges, "rule-judges")), levels.g == F.col("judge"), "left_semi"), "rule-rows"))
    weight = F.col("n_words") / (F.col("n_words") + F.lit(float(HALF_WORDS)))
    judged = (rows.join(small(known.withColumnRenamed("g", "judge")), "judge")
              .withColumn("distance", F.sqrt(_distance() * weight)))
    cutoff = math.sqrt(chi2_quantile(tail, P))
    columns = ["doc_id", *COUNTS, "base_failed"]
    return (judged.select(*columns, "distance", (F.col("distance") <= cutoff).alias("kept"))
            .union(counts.where("base_failed").select(*columns, F.lit(None).cast("double"), F.lit(False))))
