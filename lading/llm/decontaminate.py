"""Benchmark decontamination with DataFrame functions only.

Both sides are normalised to lower-case alphanumeric words.  The benchmark's
windows are 13 words (an item with fewer words is one window).  The hashes of
each window's rarest pair of neighbouring words form a set that is broadcast
behind a check of its size; every pair of every document is probed against it
without a shuffle of texts.  Where such a pair stands, the windows that hold it
are cut out of the document and compared by hash and then on the words
themselves, so a hash collision marks nothing.

Defined cases: null or wordless documents have no words and no hits; null or
wordless items have no window; items that repeat a text hit together; rows that
repeat a doc_id are judged each on its own text; empty tables give no hits;
other columns of ``docs`` pass through ``decontaminate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lading.llm.common import lower_ascii, packed, same, small, staged

WINDOW = 13
#: contaminated: at least one word in this many is hit
SHARE = 20
#: at most this many anchors' hashes are broadcast (8 bytes each); beyond, the join shuffles hashes
BROADCAST_ANCHORS = 2_000_000

NORMAL_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: the same words in a text's own case
OWN_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
#: what stands between words of a text in its own case
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"


def normal_words(text: Column) -> Column:
    """The normalised words of a text; an empty array for null."""
    words = F.regexp_extract_all(lower_ascii(text), F.lit(NORMAL_WORD), F.lit(0))
    return F.coalesce(words, F.array().cast("array<string>"))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _pair(words: Column, w: Column, i: Column) -> Column:
    """The hash of a word and the one after it; of the last word alone."""
    return F.xxhash64(w, F.get(words, i + 1))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item_id, k, words, h, anchor, o``: each distinct window of each item, its rarest pair's hash and place.

    Rarest: in the fewest items, then the longest.  A window of one word has
    that word as its pair.
    """
    w = F.col("w")
    items = (benchmark.select("item_id", normal_words(F.col("text")).alias("w"))
             .withColumn("n", F.size("w")).where("n > 0")
             .withColumn("k", F.least(F.lit(window), F.col("n"))))
    each = items.select("item_id", "k", "n", "w", F.xxhash64("w").alias("key"), F.posexplode(F.slice(
        F.transform(w, lambda x, i: F.struct(_pair(w, x, i).alias("h"), F.length(F.concat_ws("", x, F.get(w, i + 1))).alias("len"))),
        F.lit(1), F.greatest(F.col("n") - 1, F.lit(1)))).alias("p", "pair"))
    shared = (each.select("item_id", F.col("pair.h").alias("_h")).distinct()
              .groupBy("_h").agg(F.count(F.lit(1)).alias("items")))
    placed = (each.join(shared, F.col("pair.h") == F.col("_h")).groupBy("item_id", "key")
              .agg(F.first("k").alias("k"), F.first("n").alias("n"), F.first("w").alias("w"),
                   F.array_sort(F.collect_set(F.struct("p", "items", -F.col("pair.len"), "_h"))).alias("pairs")))
    cut = F.expr("transform(sequence(1, n - k + 1), i -> struct(slice(w, i, k) AS words, slice(pairs, i, greatest(k - 1, 1)) AS pairs))")
    windows = placed.select("item_id", "k", F.inline(cut))
    rarest = F.array_min(F.transform("pairs", lambda x, i: F.struct(x["items"], x["col3"], x["_h"].alias("anchor"), i.alias("o"))))
    return (windows.withColumn("rarest", rarest)
            .select("item_id", "k", "words", F.xxhash64(_hashes(F.col("words"))).alias("h"), "rarest.anchor", "rarest.o").distinct())


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, tkey, n_words, n_hit, items, hit`` of the documents with a verified hit.

    ``tkey`` is the hash of the text, which tells rows that repeat a doc_id
    apart; ``items`` are the distinct ids as strings, sorted; ``hit`` the places
    of the hit words.
    """
    base = docs.select("doc_id", "text", F.xxhash64("text").alias("tkey"))
    windows = staged(benchmark_windows(benchmark, window), "bench-windows")
    anchors = small(windows.select("anchor").distinct(), BROADCAST_ANCHORS)

    # scan: every pair of words against the windows' rarest pairs, no text is shuffled; single words if a window is one
    words = F.col("words")
    probes, step = F.transform(words, lambda w, i: _pair(words, w, i)), 1
    if not windows.where("k = 1").isEmpty():
        probes, step = F.flatten(F.transform(words, lambda w, i: F.array(_pair(words, w, i), F.xxhash64(w)))), 2
    found = (base.select("doc_id", "tkey", normal_words(F.col("text")).alias("words"))
             .select("doc_id", "tkey", F.posexplode(probes).alias("p", "anchor"))
             .withColumn("p", F.floor(F.col("p") / step).cast("int"))
             .join(anchors, "anchor", "left_semi").distinct())
    found = staged(found, "bench-found")

    # verify: only documents with a find are read again, and only they are shuffled
    ids = small(found.select(F.col("doc_id").alias("_id"), F.col("tkey").alias("_tkey")).distinct())
    on = same(F.col("doc_id"), F.col("_id")) & (F.col("tkey") == F.col("_tkey"))
    suspects = base.join(ids, on, "left_semi").distinct()
    places = windows.select("anchor", "o", "k").distinct()
    by_doc = (found.join(small(places), "anchor").select("doc_id", "tkey", (F.col("p") - F.col("o")).alias("start"), "k")
              .where("start >= 0").groupBy("doc_id", "tkey").agg(F.collect_set(F.struct("start", "k")).alias("starts"))
              .withColumnsRenamed({"doc_id": "_id", "tkey": "_tkey"}))
    cut = F.expr("transform(filter(starts, s -> s.start + s.k <= n),"
                 " s -> struct(s.start AS start, s.k AS k, slice(words, s.start + 1, s.k) AS words))")
    checked = (suspects.join(by_doc, on).drop("_id", "_tkey")
               .withColumn("words", normal_words(F.col("text"))).drop("text")
               .withColumn("n", F.size("words"))
               .select("doc_id", "tkey", "n", F.explode(cut).alias("w"))
               .select("doc_id", "tkey", "n", "w.start", "w.k", "w.words", F.xxhash64(_hashes(F.col("w.words"))).alias("h")))
    verified = checked.join(windows.select("h", "words", "item_id"), ["h", "words"])
    return (verified.groupBy("doc_id", "tkey", F.col("n").cast("long").alias("n_words"))
            .agg(F.collect_set(F.struct("start", "k")).alias("spans"),
                 F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
            .withColumn("hit", F.expr("array_distinct(flatten(transform(spans, s -> sequence(s.start, s.start + s.k - 1))))"))
            .select("doc_id", "tkey", "n_words", F.size("hit").cast("long").alias("n_hit"), "items", "hit"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, items, contaminated``."""
    hits = (staged(find_hits(docs, benchmark, window).drop("hit", "n_words"), "bench-hits")
            .withColumnsRenamed({"doc_id": "_id", "tkey": "_tkey"}))
    rows = docs.select("doc_id", F.xxhash64("text").alias("tkey"),
                       F.coalesce(F.regexp_count("text", F.lit(OWN_WORD)), F.lit(0)).cast("long").alias("n_words"))
    on = same(F.col("doc_id"), F.col("_id")) & (F.col("tkey") == F.col("_tkey"))
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (rows.join(small(hits, 100_000), on, "left")
            .select("doc_id", "n_words", hit.alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    ((hit > 0) & (hit * share >= F.col("n_words"))).alias("contaminated")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents",
                  window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """``docs`` without contamination, same columns.

    ``remove="documents"`` drops the rows whose hit words reach the share;
    ``remove="spans"`` keeps every row and cuts the hit words, with what
    follows them up to the next word, out of its text.
    """
    found = find_hits(docs, benchmark, window).withColumnsRenamed({"doc_id": "_id", "tkey": "_tkey"})
    on = same(F.col("doc_id"), F.col("_id")) & (F.xxhash64("text") == F.col("_tkey"))
    if remove == "documents":
        bad = staged(found.where((F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))
                     .select("_id", "_tkey"), "bench-bad")
        return packed(docs, "doc_id", "text").join(small(bad), on, "left_anti").select("_row.*")
    if remove != "spans":
        raise ValueError(f"remove must be 'documents' or 'spans', not {remove!r}")
    hits = staged(found.select("_id", "_tkey", "hit"), "bench-spans")
    head = F.regexp_extract("text", f"^{GAP}", 0)
    pieces = F.regexp_extract_all("text", F.lit(OWN_WORD + GAP), F.lit(0))
    left = F.concat(head, F.array_join(F.filter(pieces, lambda x, i: ~F.array_contains(F.col("hit"), i)), ""))
    return (packed(docs, "doc_id", "text").join(hits, on, "left")
            .withColumn("text", F.when(F.col("hit").isNull(), F.col("text")).otherwise(left))
            .select(*[F.col("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns]))
