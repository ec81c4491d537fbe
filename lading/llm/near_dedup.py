"""Near-duplicate detection with SetSketch registers.

A document's set is its distinct word shingles, as 64-bit hashes.  Each of the
sketch's registers keeps the minimum of an exponential variable over the set,
on an exponential scale and truncated to 16 bits; equal register values are
about as likely as the sets are similar.  Bands of register values make
candidates, a joint likelihood over the registers that are larger, equal and
smaller rejects those that cannot be similar enough, and every link is
confirmed on the full sets.

No group is turned into all its pairs.  Equal sets are one node first.  Then
every member of a band is checked against the band's smallest node only, which
joins most of a group.  A second round looks, inside each band, at nodes that are
still in different components: they are compared, and confirmed on full sets, in
blocks of ``BLOCK`` nodes and ``BLOCK_MEMBERS`` shingles, so a hot band spreads
over tasks and no pair becomes a row unless it joins two components.  That covers
every pair that shares a band, for the components.  Nodes of a band's largest
component meet only the band's other nodes: their rows are as many as the blocks
of those, so a few strays beside a hot group cost one pass over it.  Among the
others, comparisons grow with the square of their number.

With 48 bands of 5 registers a pair at exactly 0.8 shares no band with a
probability of 5e-9.

Defined cases: a document without words (or with a null text) has an empty set
and is linked with nothing; one with fewer words than a shingle has its whole
sequence as its one element; rows that repeat a doc_id are one document, with
the links of all its texts; a row with a null doc_id is linked with nothing and
kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lading.llm.common import mapped, packed, small, staged

THRESHOLD = 80  # per cent
BANDS, ROWS = 48, 5
REGISTERS = BANDS * ROWS
#: SetSketch parameters: base, rate, largest value
BASE, RATE, TOP = 1.001, 20.0, 2 ** 16 - 1
#: nodes of one band that the second round compares in one go, and the shingles they have together
BLOCK, BLOCK_MEMBERS = 4000, 4_000_000
#: a candidate is rejected when the likelihood ratio against the threshold exceeds this (5.5 sigma)
REJECT = 15.0


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(text: str | None, k: int) -> np.ndarray:
    """The sorted distinct hashes of the ``k``-word shingles of a text."""
    from xxhash import xxh3_64_intdigest

    words = (text or "").encode("utf-8").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, n)
    k = min(k, n)
    total = np.full(n - k + 1, k * 0x9E3779B97F4A7C15 % 2 ** 64, np.uint64)
    for j in range(k):
        total = _mix(total + w[j:n - k + 1 + j])
    return np.unique(total)


def multipliers(seed: int = 11) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2 ** 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def registers(members: np.ndarray, mult: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set: mergeable, the maximum of two sketches is their union's."""
    least = np.full(len(mult), 2 ** 64 - 1, np.uint64)
    for at in range(0, len(members), 256):
        np.minimum(least, np.multiply.outer(members[at:at + 256], mult).min(axis=0), out=least)
    u = (least.astype(np.float64) + 0.5) / 2.0 ** 64
    smallest = -np.log1p(-np.minimum(u, 1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(smallest) / math.log(BASE)), 0, TOP).astype(np.uint16)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of register values; a row of registers or many."""
    key = np.arange(BANDS, dtype=np.uint64)
    for column in np.moveaxis(regs.reshape(*regs.shape[:-1], BANDS, ROWS), -1, 0).astype(np.uint64):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / math.log(BASE)


def log_likelihood(jac, more, less, equal, na, nb):
    """Joint log-likelihood of similarity ``jac`` given how registers compare and both set sizes."""
    u, v = na / (na + nb), nb / (na + nb)
    jac = np.minimum(jac, np.minimum(u / v, v / u))
    a, b = np.clip(_p(u - v * jac), 1e-9, 1), np.clip(_p(v - u * jac), 1e-9, 1)
    return more * np.log(a) + less * np.log(b) + equal * np.log(np.clip(1 - a - b, 1e-9, 1))


def possible(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray, threshold: int) -> np.ndarray:
    """Whether the registers allow the threshold: rows of registers, set sizes."""
    more, less = (ra > rb).sum(axis=1), (ra < rb).sum(axis=1)
    equal = ra.shape[1] - more - less
    grid = np.linspace(0.0, 1.0, 51)[:, None]
    every = log_likelihood(grid, more, less, equal, na, nb)
    best, at = every.max(axis=0), log_likelihood(threshold / 100, more, less, equal, na, nb)
    return (grid[every.argmax(axis=0), 0] >= threshold / 100) | (best - at <= REJECT)


def _sketch_partition(k: int):
    def run(batches):
        import pyarrow as pa

        mult = multipliers()
        for b in batches:
            size, key, regs = [], [], []
            for text in b.column(1).to_pylist():
                got = shingles(text, k)
                size.append(len(got))
                key.append(hashlib.blake2b(got.tobytes(), digest_size=16).digest() if len(got) else None)
                regs.append(registers(got, mult).tobytes() if len(got) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(key, pa.binary()),
                                              pa.array(regs, pa.binary())], names=["doc_id", "n", "set_key", "regs"])

    return run


def _band_partition(batches):
    import pyarrow as pa

    for b in batches:
        regs = b.column(2).to_pylist()
        keys = np.concatenate([band_keys(np.frombuffer(r, np.uint16)) for r in regs]) if regs else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()),
                                          pa.array(np.repeat(b.column(0).to_numpy(), BANDS), pa.int64()),
                                          pa.array(np.repeat(b.column(1).to_numpy(), BANDS), pa.int64())],
                                         names=["key", "node", "n"])


def _possible_partition(threshold: int):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            if b.num_rows:
                ra, rb = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS) for i in (4, 5))
                ok = possible(ra, rb, b.column(2).to_numpy(), b.column(3).to_numpy(), threshold)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok))

    return run


def _confirm_partition(k: int, threshold: int):
    def run(batches):
        import pyarrow as pa

        last, one = None, None
        for b in batches:
            ok = []
            for lead, ta, tb in zip(*(b.column(i).to_pylist() for i in (1, 2, 3))):
                if last != (lead, tb):  # pairs come sorted by lead: its set is made once
                    last, one = (lead, tb), shingles(tb, k)
                other = shingles(ta, k)
                both = len(np.intersect1d(one, other, assume_unique=True))
                ok.append(100 * both >= threshold * (len(one) + len(other) - both) > 0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _block_pairs(rows: list, threshold: int):
    """(i, j) of a block's rows whose registers admit the threshold, between nodes of different components.

    A pair that shares several bands is looked at in the first of them only.
    Rows are (key, i, j, node, n, label, side, regs, ..).
    """
    key, cross = rows[0][0], rows[0][1] != rows[0][2]
    n, label, side = (np.array([r[c] for r in rows]) for c in (4, 5, 6))
    regs = np.frombuffer(b"".join(r[7] for r in rows), np.uint16).reshape(len(rows), REGISTERS)
    bands = band_keys(regs)
    share = threshold / 100
    least = REGISTERS * share - 6 * math.sqrt(REGISTERS * share * (1 - share))
    for i in range(len(rows) - 1):
        rest = slice(i + 1, None)
        fit = (label[rest] != label[i]) & (np.minimum(n[rest], n[i]) * 100 >= np.maximum(n[rest], n[i]) * threshold)
        if cross:
            fit &= side[rest] != side[i]
        at = np.flatnonzero(fit) + i + 1
        at = at[(regs[at] == regs[i]).sum(axis=1) >= least]
        if len(at):
            at = at[bands[i][(bands[at] == bands[i]).argmax(axis=1)] == key]
        if len(at):
            ok = possible(regs[at], np.broadcast_to(regs[i], (len(at), REGISTERS)), n[at], np.full(len(at), n[i]), threshold)
            yield from ((i, j) for j in at[ok])


def _by_block(batches):
    """The rows of each block, which come sorted."""
    held = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[0][:3] != row[:3]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _suspect_partition(threshold: int):
    """The rows of a block that are in some admitted pair."""
    def run(batches):
        import pyarrow as pa

        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
        names = ["key", "i", "j", "node", "n", "label", "side"]
        for rows in _by_block(batches):
            found = sorted({x for pair in _block_pairs(rows, threshold) for x in pair})
            if found:
                columns = zip(*(rows[x][:7] for x in found))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def _join_partition(k: int, threshold: int):
    """Links that join components of a block: admitted pairs, confirmed on the full sets of their texts."""
    def run(batches):
        import pyarrow as pa

        for rows in _by_block(batches):
            sets, parent, links = {}, {}, []

            def find(x):
                while parent.setdefault(x, x) != x:
                    x = parent[x]
                return x

            for pair in _block_pairs(rows, threshold):
                la, lb = (find(rows[x][5]) for x in pair)
                if la == lb:  # joined by an earlier link of the block
                    continue
                one, other = (sets[x] if x in sets else sets.setdefault(x, shingles(rows[x][8], k)) for x in pair)
                both = len(np.intersect1d(one, other, assume_unique=True))
                if 100 * both >= threshold * (len(one) + len(other) - both) > 0:
                    parent[max(la, lb)] = min(la, lb)
                    links.append((rows[pair[0]][3], rows[pair[1]][3]))
            if links:
                a, b = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def likely_pairs(pairs: DataFrame, nodes: DataFrame, threshold: int) -> DataFrame:
    """The ``a, b`` of ``pairs`` (``a, b, na, nb``) whose registers admit the threshold."""
    regs = nodes.select("node", "regs")
    both = (pairs.join(regs.withColumnsRenamed({"node": "a", "regs": "ra"}), "a")
            .join(regs.withColumnsRenamed({"node": "b", "regs": "rb"}), "b")
            .select("a", "b", "na", "nb", "ra", "rb"))
    return mapped(both, _possible_partition(threshold), "a long, b long").distinct()


def links_apart(placed: DataFrame, nodes: DataFrame, docs: DataFrame, k: int, threshold: int) -> DataFrame:
    """Links ``a, b`` that join components, among ``key, node, n, label`` rows of one key and different labels.

    A key's nodes are dealt into blocks, those of its largest component by
    themselves; every pair of blocks but two of that component is one unit of
    work.  A first pass over registers keeps the nodes that are in an admitted
    pair; only they bring their texts to the second, which confirms inside the
    block.  Pairs never become rows, only links that join components do.
    """
    labels = placed.groupBy("key", "label").agg(F.count(F.lit(1)).alias("nodes"), F.sum("n").alias("members"))
    blocks = lambda nodes, members: F.greatest(F.ceil(nodes / F.lit(BLOCK)), F.ceil(members / F.lit(BLOCK_MEMBERS))).cast("int")
    largest = F.max(F.struct("nodes", "label", "members"))
    sizes = (labels.groupBy("key").agg(largest.alias("top"), F.sum("nodes").alias("nodes"), F.sum("members").alias("members"))
             .where("nodes > top.nodes")
             .select("key", F.col("top.label").alias("major"), blocks(F.col("top.nodes"), F.col("top.members")).alias("majors"),
                     blocks(F.col("nodes") - F.col("top.nodes"), F.col("members") - F.col("top.members")).alias("minors")))
    regs = nodes.select("node", "regs")
    block = ["key", "i", "j"]
    # blocks of the largest component come first and meet only the others, which also meet each other
    of_major = F.col("label") == F.col("major")
    dealt = F.xxhash64("node")
    apart = (placed.join(sizes, "key")
             .withColumn("side", F.when(of_major, F.pmod(dealt, F.col("majors")))
                         .otherwise(F.col("majors") + F.pmod(dealt, F.col("minors"))).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.when(of_major, F.col("majors")).otherwise(0),
                                                       F.col("majors") + F.col("minors") - 1)))
             .join(regs, "node")
             .select("key", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"),
                     "node", "n", "label", "side", "regs"))
    suspects = staged(mapped(
        apart.repartition(*block).sortWithinPartitions(*block), _suspect_partition(threshold), "key long, i int, j int, node long, n long, label long, side int"), "near-suspects")
    ids = small(suspects.select(F.col("node").alias("doc_id")).distinct())
    texts = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi").withColumnRenamed("doc_id", "node")
    told = (suspects.join(regs, "node").join(texts, "node")
            .select(*block, "node", "n", "label", "side", "regs", "text"))
    return staged(mapped(told.repartition(*block).sortWithinPartitions(*block), _join_partition(k, threshold), "a long, b long")
                  .distinct(), "near-joins")


def confirmed(likely: DataFrame, docs: DataFrame, k: int, threshold: int) -> DataFrame:
    """The ``a, b`` of ``likely`` whose full sets reach the threshold.

    Only texts of documents that are in a pair are shuffled.
    """
    likely = staged(likely, "near-likely")
    ids = small(likely.select(F.col("a").alias("doc_id")).union(likely.select("b")).distinct())
    texts = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    sides = (likely.join(texts.withColumnsRenamed({"doc_id": "a", "text": "ta"}), "a")
             .join(texts.withColumnsRenamed({"doc_id": "b", "text": "tb"}), "b")
             .select("a", "b", "ta", "tb").sortWithinPartitions("b"))
    return staged(mapped(sides, _confirm_partition(k, threshold), "a long, b long").distinct(), "near-links")


def components(links: DataFrame) -> DataFrame:
    """``node, label``: the smallest node reachable from each node of ``links`` (``a, b``).

    Each round takes the smallest label among the neighbours, then follows the
    label's own label; rounds are written out, so lineage stays short.
    """
    edges = staged(links.select("a", "b").union(links.select("b", "a")).distinct(), "near-edges")
    labels = staged(edges.groupBy(F.col("a").alias("node"))
                    .agg(F.least(F.min("b"), F.first("a")).alias("label")), "near-labels")
    while True:
        near = (edges.join(labels, edges.b == labels.node).groupBy(F.col("a").alias("node"))
                .agg(F.min("label").alias("near")))
        hooked = labels.join(near, "node").select("node", F.col("label").alias("old"),
                                                  F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        after = staged(hooked.join(up, "label", "left")
                       .select("node", "old", F.least("label", F.coalesce("up", "label")).alias("label")), "near-labels")
        moved = after.where("label <> old").limit(1).count()
        labels = after.select("node", "label")
        if not moved:
            return labels


def near_duplicates(docs: DataFrame, shingle_words: int = 5, threshold: int = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept, class_id``.

    ``class_id`` is the smallest doc_id with the same set, ``component_id`` the
    smallest reachable over links of at least ``threshold`` per cent.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = staged(mapped(docs, _sketch_partition(shingle_words),
                                      "doc_id long, n long, set_key binary, regs binary"), "near-sketches")
    real = sketches.where("doc_id IS NOT NULL AND n > 0")

    # equal sets are one node; partial aggregation keeps a hot class to a row per task
    classes = real.groupBy("set_key").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("members"))
    shared = staged(classes.where("members > 1").select("set_key", "class_id"), "near-classes")
    known = sketches.join(small(shared.withColumnRenamed("set_key", "_key")), F.col("set_key") == F.col("_key"), "left")
    rows = staged(known.select("doc_id", "n", "set_key",
                               F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id")),
                  "near-rows")
    nodes = (real.join(rows.where("doc_id = class_id").select("doc_id", "set_key").distinct(), ["doc_id", "set_key"], "left_semi")
             .select(F.col("doc_id").alias("node"), "n", "regs").dropDuplicates(["node", "regs"]))
    nodes = staged(nodes, "near-nodes")
    bands = mapped(nodes, _band_partition, "key long, node long, n long")

    # first round: every member of a band against the band's smallest node
    led = (bands.groupBy("key").agg(F.min(F.struct("node", "n")).alias("lead"), F.max("node").alias("top"))
           .where("lead.node < top"))
    led = staged(led.select("key", "lead"), "near-leads")
    crowd = staged(bands.join(led, "key").select("key", "node", "n", "lead"), "near-bands")
    fits = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * threshold
    star = (crowd.where("node > lead.node")
            .select(F.col("node").alias("a"), F.col("lead.node").alias("b"), F.col("n").alias("na"), F.col("lead.n").alias("nb"))
            .where(fits).distinct())
    # a doc_id with several texts ties their classes together
    ties = (rows.where("doc_id <> class_id AND n > 0").select("doc_id", "class_id").distinct()
            .join(rows.where("n > 0").select("doc_id", F.col("class_id").alias("other")).distinct(), "doc_id")
            .where("class_id <> other").select(F.col("class_id").alias("a"), F.col("other").alias("b")))
    links = staged(confirmed(likely_pairs(star, nodes, threshold), docs, shingle_words, threshold).union(ties), "near-links")
    labels = components(links)

    # second round: inside a band, nodes of different components; the smallest node was checked
    placed = (crowd.where("node > lead.node").select("key", "node", "n").join(labels, "node", "left")
              .withColumn("label", F.coalesce("label", "node")))
    again = links_apart(placed, nodes, docs, shingle_words, threshold)
    if not again.isEmpty():
        labels = components(links.union(again))
    labels = small(labels.withColumnRenamed("node", "_node"))
    final = F.coalesce("label", "class_id")
    return (rows.join(labels, F.col("class_id") == F.col("_node"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), final.alias("component_id"),
                    F.coalesce(F.col("doc_id") == final, F.lit(True)).alias("kept"), "class_id"))


def deduplicate(docs: DataFrame, shingle_words: int = 5, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest doc_id; same columns.

    Of rows that repeat that doc_id the one whose text has the smallest hash stays.
    """
    found = staged(near_duplicates(docs, shingle_words, threshold).select("doc_id", "kept"), "near-found")
    gone = found.where("NOT kept").select(F.col("doc_id").alias("_id")).distinct()
    out = packed(docs, F.col("doc_id").cast("long").alias("doc_id")).join(small(gone), F.col("doc_id") == F.col("_id"), "left_anti")
    twice = staged(found.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
                   .select(F.col("doc_id").alias("_id")), "near-twice")
    if twice.isEmpty():
        return out.select("_row.*")
    on = F.col("doc_id") == F.col("_id")
    text = F.col("_row.text")
    once = (out.join(small(twice), on, "left_semi").groupBy("doc_id")
            .agg(F.min_by("_row", F.struct(F.xxhash64(text), text)).alias("_row")))
    return out.join(small(twice), on, "left_anti").select("_row").union(once.select("_row")).select("_row.*")
