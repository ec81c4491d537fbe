"""Repeated passages with sparse suffix arrays.

Of every window of ``MIN_WORDS`` words the least hash of its word ``GRAM``-grams
selects a position; only the suffixes at selected positions are retained (about
one in 18 words), each with the words its windows reach to the left and right.
Two occurrences of a passage of ``MIN_WORDS`` words select the same place in it.

Suffixes whose gram stands in one document only are let go; equal ones (same
gram, same words around) become one.  The others are sorted by gram and by what
follows.  Words shared with the sorted neighbour give how far suffixes agree to
the right; a second order, by what precedes, gives the same to the left.  For
every split of ``MIN_WORDS`` into left and right words, suffixes in one interval
of either order hold the same passage, so a match is found whatever the direct
neighbours are, and its words are compared one by one.

A gram with more than ``PART`` different surroundings is sorted in several
parts, whose intervals are merged by a hash of their words.  Grams, surroundings
and passages that are more than one in 20,000 get their partner by broadcast.
Documents with the same words are one document while comparing.

Words are runs of non-white space with A-Z in lower case, compared by hash.

Defined cases: null, empty and shorter texts have no repeats; a passage that
occurs only inside one document is no repeat; rows with a null doc_id
or that repeat a doc_id take part, each with its own text, and are reported under
that id, null as the smallest; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lading.llm.common import mapped, packed, same, small, staged

MIN_WORDS = 50
GRAM = 16
#: different surroundings of one gram that are sorted together
PART = 20_000
#: rows a task sorts and compares at a time, in whole groups
ROWS = 40_000
#: stands for a null doc_id
NO_ID = -2 ** 63

SUFFIX = "array<struct<key:long,ctx:long,at:int,first:int,last:int>>"
ODD = np.uint64(0x9E3779B97F4A7C15)
ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2 ** 64))


def word_hashes(text: str | None) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    words = (text or "").encode("utf-8").lower().split()
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def digest(w: np.ndarray) -> bytes:
    return hashlib.blake2b(w.tobytes(), digest_size=16).digest()


def mixed(a: np.ndarray, b) -> np.ndarray:
    return (a ^ (a >> np.uint64(31))) * ODD + b


def gram_hashes(w: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of the ``gram`` words from each position on."""
    h = np.zeros(len(w) - gram + 1, np.uint64)
    for j in range(gram):
        h = mixed(h, w[j:len(w) - gram + 1 + j])
    return h ^ (h >> np.uint64(29))


def minimisers(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the least (the leftmost one) of every ``width`` consecutive hashes."""
    def least(a, b):
        return np.where(h[b] < h[a], b, a)

    at, k = np.arange(len(h)), 1
    while 2 * k <= width:
        at, k = least(at[:-k], at[k:]), 2 * k
    return least(at[:len(at) - (width - k)], at[width - k:])


def retained(w: np.ndarray, gram: int, min_words: int) -> tuple[np.ndarray, ...]:
    """``key, ctx, at, first, last`` of the retained suffixes of a text.

    ``first`` and ``last`` are where the windows that select the suffix begin;
    ``ctx`` is a hash of all words in them and of their place around it.
    """
    if len(w) < min_words:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int32, np.int32, np.int32))
    h = gram_hashes(w, gram)
    picked = minimisers(h, min_words - gram + 1)
    first = np.flatnonzero(np.diff(picked, prepend=-1))
    last = np.append(first[1:], len(picked)) - 1
    at = picked[first]
    sums = np.append(np.uint64(0), np.cumsum(w * np.cumprod(np.full(len(w), ODD))))
    ctx = (sums[last + min_words] - sums[first]) * np.cumprod(np.full(len(w), ODD_INVERSE))[first]
    ctx = mixed(mixed(ctx, (at - first).astype(np.uint64)), (last - first).astype(np.uint64))
    return (h[at].view(np.int64), ctx.view(np.int64), at.astype(np.int32), first.astype(np.int32), last.astype(np.int32))


def _select_partition(gram: int, min_words: int):
    """The retained suffixes of each document."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            n, same_words, parts = [], [], []
            for text in b.column(1).to_pylist():
                w = word_hashes(text)
                n.append(len(w))
                same_words.append(digest(w))
                parts.append(retained(w, gram, min_words))
            if not n:
                continue
            offsets = np.cumsum([0, *(len(p[0]) for p in parts)]).astype(np.int32)
            suffixes = pa.StructArray.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)],
                                                  names=["key", "ctx", "at", "first", "last"])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(same_words, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets), suffixes)], names=["doc_id", "n", "same_words", "suffixes"])

    return run


ASKED = "key long, ctx long, part int, parts int, low long, high long, ulow long, uhigh long, most int, least int"


def _words_partition(min_words: int):
    """The asked suffixes with the words they are sorted by: those that follow, and those that precede, nearest first."""
    names = [c.split()[0] for c in ASKED.split(", ")]

    def run(batches):
        import pyarrow as pa

        schema = pa.schema([(c, pa.int32() if t == "int" else pa.int64()) for c, t in (c.split() for c in ASKED.split(", "))]
                           + [("left", pa.binary()), ("right", pa.binary())])
        for b in batches:
            rows = {c: [] for c in schema.names}
            for text, asked in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = word_hashes(text)
                ahead, back = w.astype(">u8").tobytes(), w[::-1].astype(">u8").tobytes()
                for a in asked:
                    at, behind = a["at"], 8 * (len(w) - a["at"])
                    for c in names[:-2]:
                        rows[c].append(a[c])
                    rows["most"].append(at - a["first"])
                    rows["least"].append(at - a["last"])
                    rows["left"].append(back[behind:behind + 8 * (at - a["first"])])
                    rows["right"].append(ahead[8 * at:8 * (a["last"] + min_words)])
                    if len(rows["key"]) >= 10_000:
                        yield pa.RecordBatch.from_pydict(rows, schema)
                        rows = {c: [] for c in schema.names}
            if rows["key"]:
                yield pa.RecordBatch.from_pydict(rows, schema)

    return run


def _word_matrix(values: list[bytes], width: int) -> np.ndarray:
    sizes = np.array([len(v) // 8 for v in values])
    out = np.zeros((len(values), width), np.uint64)
    out[np.arange(width) < sizes[:, None]] = np.frombuffer(b"".join(values), ">u8")
    return out


def _common(words: np.ndarray, group: np.ndarray) -> np.ndarray:
    """How many words each sorted row has in common with the one before; -1 at a group's first."""
    out = np.full(len(words), -1)
    out[1:] = np.logical_and.accumulate(words[1:] == words[:-1], axis=1).sum(axis=1)
    out[1:][group[1:] != group[:-1]] = -1
    return out


def _chain(words: np.ndarray) -> list[np.ndarray]:
    out = [np.zeros(len(words), np.uint64)]
    for j in range(words.shape[1]):
        out.append(mixed(out[-1], words[:, j]))
    return out


def matches(group, left, right, most, least, low, high, ulow, uhigh, min_words: int):
    """Yield ``l, rows, low, high, ulow, uhigh``: of every split the rows and what their interval's documents are.

    Rows come sorted by ``group`` and the words to the right.  Those in one
    interval of ``min_words - l`` words to the right and one of ``l`` words to the
    left hold the same passage.
    """
    order = np.argsort(np.ascontiguousarray(np.column_stack([group.astype(np.uint64), left]).astype(">u8"))
                       .view(f"S{8 * (left.shape[1] + 1)}").ravel(), kind="stable")
    ahead, behind = _common(right, group), _common(left[order], group[order])
    back = np.empty(len(group), np.int64)
    for l in range(left.shape[1] + 1):  # noqa: E741
        rows = np.flatnonzero((least <= l) & (l <= most))
        if not len(rows):
            continue
        back[order] = np.cumsum(behind < l)
        interval = np.cumsum(ahead < min_words - l)[rows] * (len(group) + 1) + back[rows]
        by = np.argsort(interval, kind="stable")
        starts = np.flatnonzero(np.diff(interval[by], prepend=-1))
        sizes = np.diff(np.append(starts, len(by)))
        rows = rows[by]
        ends = (np.repeat(f.reduceat(c[rows], starts), sizes)
                for f, c in ((np.minimum, low), (np.maximum, high), (np.minimum, ulow), (np.maximum, uhigh)))
        yield l, rows, *ends


RUN = "key long, ctx long, least int, most int, low long, high long, ulow long, uhigh long, hash long"


def _compare_partition(gram: int, min_words: int):
    """Runs of splits at which a suffix has a match; of grams in parts each split by itself, with its words' hash."""
    def compared(t):
        import pyarrow as pa

        col = {c: t.column(c).to_numpy() for c in t.schema.names if c not in ("left", "right")}
        group = np.cumsum((np.diff(col["key"], prepend=col["key"][0]) != 0) | (np.diff(col["part"], prepend=col["part"][0]) != 0))
        left = _word_matrix(t.column("left").to_pylist(), min_words - gram)
        right = _word_matrix(t.column("right").to_pylist(), min_words)
        several = col["parts"] > 1
        chains = (_chain(left), _chain(right)) if several.any() else None
        whole, parted = [], []
        for l, rows, *ends in matches(group, left, right, *(col[c] for c in ("most", "least", "low", "high", "ulow", "uhigh")),  # noqa: E741
                                      min_words):
            keep = ~several[rows] & (ends[2] != ends[3])
            whole.append((rows[keep], np.full(keep.sum(), l), *(e[keep] for e in ends)))
            if chains:
                keep = several[rows]
                rows, ends = rows[keep], [e[keep] for e in ends]
                hashes = mixed(mixed(chains[0][l][rows], chains[1][min_words - l][rows]), np.uint64(l))
                parted.append((rows, np.full(len(rows), l), *ends, hashes.view(np.int64)))
        rows, ls, *ends = (np.concatenate(c) for c in zip(*whole))
        by = np.lexsort((ls, rows))
        rows, ls, ends = rows[by], ls[by], [e[by] for e in ends]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (ls[1:] != ls[:-1] + 1)
        for e in ends:
            new[1:] |= e[1:] != e[:-1]
        starts = np.flatnonzero(new)
        until = np.append(starts[1:], len(rows))[:len(starts)] - 1
        out = [(rows[starts], ls[starts], ls[until], *(e[starts] for e in ends), None)]
        out += [(p[0], p[1], p[1], *p[2:]) for p in parted]
        for rows, least, most, low, high, ulow, uhigh, hashes in out:
            for i in range(0, len(rows), 100_000):
                s = slice(i, i + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(col["key"][rows[s]]), pa.array(col["ctx"][rows[s]]), pa.array(least[s].astype(np.int32)),
                     pa.array(most[s].astype(np.int32)), *(pa.array(c[s]) for c in (low, high, ulow, uhigh)),
                     pa.nulls(len(rows[s]), pa.int64()) if hashes is None else pa.array(hashes[s])],
                    names=[c.split()[0] for c in RUN.split(", ")])

    def run(batches):
        import pyarrow as pa

        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.num_rows
            if size >= ROWS:
                t = pa.Table.from_batches(held).combine_chunks()
                key, part = (t.column(c).to_numpy() for c in ("key", "part"))
                begin = np.flatnonzero((key != key[-1]) | (part != part[-1]))
                begin = int(begin[-1]) + 1 if len(begin) else 0
                if begin:
                    yield from compared(t.slice(0, begin))
                held, size = t.slice(begin).to_batches(), t.num_rows - begin
        if size:
            yield from compared(pa.Table.from_batches(held).combine_chunks())

    return run


def _joined(many: DataFrame, few: DataFrame, total: int, *on: str) -> DataFrame:
    """``many`` joined with ``few``, whose ``n`` says how many rows of ``many`` have its key.

    Keys of more than one in 20,000 rows, so at most 20,000 of them, are broadcast.
    """
    often = F.col("n") > max(1000, total // 20_000)
    hot, cold = few.where(often).drop("n"), few.where(~often).drop("n")
    rest = many.join(F.broadcast(hot.select(*on).distinct()), list(on), "left_anti")
    return many.join(F.broadcast(hot), list(on)).unionByName(rest.join(cold, list(on)))


def _passages(nodes: DataFrame, docs: DataFrame, gram: int, min_words: int) -> DataFrame:
    """``uid, node, start, last, low, high`` of the windows of each document that another one has, in runs."""
    members = nodes.select("uid", "node", F.inline("suffixes"))
    keys = staged(members.groupBy("key").agg(F.min("uid").alias("ulow"), F.max("uid").alias("uhigh"), F.count(F.lit(1)).alias("n"))
                  .where("ulow < uhigh").select("key", "n"), "repeat-grams")
    total = nodes.agg(F.coalesce(F.sum(F.size("suffixes")), F.lit(0))).first()[0]
    kept = staged(_joined(members, keys, total, "key"), "repeat-kept")
    contexts = staged(kept.groupBy("key", "ctx").agg(
        F.min("node").alias("low"), F.max("node").alias("high"), F.min("uid").alias("ulow"), F.max("uid").alias("uhigh"),
        F.min(F.struct("uid", "at", "first", "last")).alias("one"), F.count(F.lit(1)).alias("members")), "repeat-contexts")
    around = contexts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).withColumn("parts", F.ceil(F.col("n") / PART).cast("int"))
    around = _joined(contexts, staged(around.where("n > 1"), "repeat-around"), contexts.count(), "key")
    asked = (around.withColumn("part", F.pmod("ctx", "parts").cast("int"))
             .groupBy(F.col("one.uid").alias("uid"))
             .agg(F.collect_list(F.struct("key", "ctx", "part", "parts", "low", "high", "ulow", "uhigh",
                                          "one.at", "one.first", "one.last")).alias("asked")))
    asked = staged(asked.join(nodes.select("uid", "node"), "uid"), "repeat-asked")
    sorted_by = (mapped(_with_texts(asked, docs).select("text", "asked"), _words_partition(min_words),
                        f"{ASKED}, left binary, right binary")
                 .repartition("key", "part").sortWithinPartitions("key", "part", "right"))
    runs = staged(mapped(sorted_by, _compare_partition(gram, min_words), RUN), "repeat-runs")
    # grams in parts: an interval's documents are those of its pieces in all parts
    parted = runs.where("hash IS NOT NULL").drop("uhigh", "ulow", "low", "high")
    pieces = (runs.where("hash IS NOT NULL").groupBy("key", "hash")
              .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.min("ulow").alias("ulow"),
                   F.max("uhigh").alias("uhigh"), F.count(F.lit(1)).alias("n")).where("ulow < uhigh"))
    parted = _joined(parted, staged(pieces, "repeat-pieces"), parted.count(), "key", "hash")
    columns = ("key", "ctx", "least", "most", "low", "high")
    # surroundings that all members of a gram share
    alone = (contexts.where("ulow < uhigh").join(_lone(contexts), ["key", "ctx"], "left_semi")
             .select("key", "ctx", (F.col("one.at") - F.col("one.last")).alias("least"),
                     (F.col("one.at") - F.col("one.first")).alias("most"), "low", "high"))
    found = runs.where("hash IS NULL").select(*columns).unionByName(parted.select(*columns)).unionByName(alone)
    found = staged(found.join(contexts.select("key", "ctx", F.col("members").alias("n")), ["key", "ctx"]), "repeat-found")
    return (_joined(kept, found, kept.count(), "key", "ctx")
            .select("uid", "node", (F.col("at") - F.col("most")).cast("long").alias("start"),
                    (F.col("at") - F.col("least")).cast("long").alias("last"), "low", "high"))


def _lone(contexts: DataFrame) -> DataFrame:
    return contexts.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("ctx").alias("ctx")).where("n = 1").select("key", "ctx")


def _with_texts(asked: DataFrame, docs: DataFrame) -> DataFrame:
    """``asked`` with each document's text."""
    ids = small(asked.select(F.col("node").alias("_node")).distinct())
    texts = (docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("node"), "text")
             .join(ids, F.col("node") == F.col("_node"), "left_semi"))
    if texts.groupBy("node").count().where("count > 1").isEmpty():
        return asked.join(texts, "node")
    # rows that share an id: by their words
    texts = texts.select(F.xxhash64(words_digest("text")).alias("uid"), "text").dropDuplicates(["uid"])
    return asked.join(texts, "uid")


def _joined_spans(found: DataFrame, min_words: int) -> DataFrame:
    """``uid, start, n_words, other, cut`` from runs of shared windows; spans that touch are one.

    A window belongs to its smallest document; ``cut`` are the ranges of words in
    windows that belong to another.
    """
    mine = F.col("node") <= F.col("low")
    found = found.select("uid", "start", "last", F.when(mine, F.col("high")).otherwise(F.col("low")).alias("other"),
                         F.when(~mine, F.col("start")).alias("gone"), F.when(~mine, F.col("last")).alias("gone_last"))
    by_doc = Window.partitionBy("uid").orderBy("start", "last")
    so_far = by_doc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = by_doc.rowsBetween(Window.unboundedPreceding, -1)
    isles = (found.withColumn("ahead", F.max("last").over(earlier)).withColumn("before", F.max("gone_last").over(earlier))
             .withColumn("isle", F.sum(F.when(F.col("start") - F.col("ahead") <= min_words, 0).otherwise(1)).over(so_far))
             .withColumn("hole", F.sum(F.when(F.col("gone").isNull() | (F.col("gone") - F.col("before") <= min_words), 0)
                                       .otherwise(1)).over(so_far)))
    holes = isles.groupBy("uid", "isle", "hole").agg(
        F.min("start").alias("start"), F.max("last").alias("last"), F.min("other").alias("other"),
        F.min("gone").alias("gone"), (F.max("gone_last") + min_words - F.min("gone")).alias("n_gone"))
    return (holes.groupBy("uid", "isle")
            .agg(F.min("start").alias("start"), F.max("last").alias("last"), F.min("other").alias("other"),
                 F.sort_array(F.collect_list(F.when(F.col("gone").isNotNull(), _range("gone", "n_gone")))).alias("cut"))
            .select("uid", "start", (F.col("last") + min_words - F.col("start")).alias("n_words"), "other", "cut"))


def _range(start, n):
    return F.struct(F.col(start).alias("start"), F.col(n).alias("n_words"))


def _spans(docs: DataFrame, min_words: int, gram: int) -> DataFrame:
    """``doc_id, same_words, start, n_words, repeat_of, cut`` (see ``repeated_spans``); ``same_words`` is the words' digest."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    picked = staged(mapped(docs, _select_partition(gram, min_words),
                           f"doc_id long, n long, same_words binary, suffixes {SUFFIX}")
                    .where(F.col("n") >= min_words), "repeat-picked").withColumn("node", F.coalesce("doc_id", F.lit(NO_ID)))
    # documents with the same words: one node, and whole repeats
    classes = picked.groupBy("same_words").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("members"),
                                               F.max("node").alias("top"))
    shared = staged(classes.where("members > 1"), "repeat-classes").withColumnRenamed("same_words", "_same")
    whole = (picked.select("node", "n", "same_words").join(small(shared), F.col("same_words") == F.col("_same"))
             .select("node", "same_words", F.lit(0).cast("long").alias("start"), F.col("n").alias("n_words"), "first", "top",
                     F.xxhash64("same_words").alias("uid")))
    nodes = (picked.select("same_words", F.struct("node", "suffixes").alias("v"), F.xxhash64("same_words").alias("uid"))
             .join(small(shared.select("_same")), F.col("same_words") == F.col("_same"), "left"))
    single = nodes.where("_same IS NULL").select("same_words", "v", "uid")
    several = nodes.where("_same IS NOT NULL").groupBy("same_words").agg(F.min("v").alias("v"), F.first("uid").alias("uid"))
    nodes = staged(single.union(several), "repeat-nodes").select("same_words", "uid", "v.*")

    spans = staged(_joined_spans(_passages(nodes, docs, gram, min_words), min_words).join(nodes.select("uid", "same_words", "node"), "uid")
                   .join(small(shared.select("_same")), F.col("same_words") == F.col("_same"), "left"), "repeat-spans")
    # of documents with the same words the first is cut like any other, the rest are cut whole
    own = (spans.where("_same IS NOT NULL").groupBy(F.col("uid").alias("_uid"))
           .agg(F.min(F.when(F.size("cut") > 0, F.col("other"))).alias("low"), F.sort_array(F.flatten(F.collect_list("cut"))).alias("own")))
    later = F.col("node") > F.col("first")
    whole = whole.join(small(own), F.col("uid") == F.col("_uid"), "left").select(
        "node", "same_words", "start", "n_words",
        F.coalesce("low", F.when(later, F.col("first")).otherwise(F.col("top"))).alias("other"),
        F.when(later, F.array(_range("start", "n_words"))).otherwise(F.coalesce("own", F.array().cast(spans.schema["cut"].dataType))).alias("cut"))
    named = lambda c: F.when(F.col(c) > NO_ID, F.col(c))
    return (spans.where("_same IS NULL").select("node", "same_words", "start", "n_words", "other", "cut").union(whole)
            .select(named("node").alias("doc_id"), "same_words", "start", "n_words", named("other").alias("repeat_of"), "cut"))


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, gram: int = GRAM) -> DataFrame:
    """``doc_id, start, n_words, repeat_of, cut`` of every repeated passage, in words of its document.

    ``repeat_of`` is the smallest document with ``min_words`` words of the
    passage, or in the smallest itself one of the others.  ``cut`` are the ranges
    of its words that a smaller document has in ``min_words`` equal words.
    """
    return _spans(docs, min_words, gram).drop("same_words")


@F.pandas_udf(T.BinaryType())
def words_digest(text: pd.Series) -> pd.Series:
    """The digest of each text's words."""
    return pd.Series([digest(word_hashes(t)) for t in text], dtype=object)


@F.pandas_udf(T.StringType())
def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
    """Texts without the words of their spans, each word with the white space behind it."""
    word = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")

    def one(t, cuts):
        raw = t.encode("utf-8")
        pieces = [m.span() for m in word.finditer(raw)]
        out, last = [], 0
        for start, n in sorted((s["start"], s["n_words"]) for s in cuts):
            out.append(raw[last:pieces[start][0]])
            last = pieces[start + n - 1][1]
        return b"".join([*out, raw[last:]]).decode("utf-8")

    return pd.Series([t if cuts is None or t is None else one(t, cuts) for t, cuts in zip(text, spans)])


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, gram: int = GRAM) -> DataFrame:
    """``docs`` without the passages that repeat one of a smaller doc_id; same columns.

    Every ``min_words`` equal words belong to the smallest document that has
    them (a null doc_id is the smallest), which does not lose them to a larger
    one; so each word cut stands in a smaller document.  Rows that share a
    doc_id keep what only they share; each is cut by its own words.
    """
    spans = (_spans(docs, min_words, gram)
             .select(F.col("doc_id").alias("_id"), F.col("same_words").alias("_same"), F.explode("cut").alias("cut")).distinct()
             .groupBy("_id", "_same").agg(F.collect_list("cut").alias("_spans")))
    once = staged(spans, "repeat-cuts")
    mine = same(F.col("doc_id"), F.col("_id")) & (F.col("_words") == F.col("_same"))
    return (packed(docs, "doc_id", "text").withColumn("_words", words_digest("text")).join(small(once, 100_000), mine, "left")
            .select(*[cut("text", "_spans").alias(c) if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns]))
