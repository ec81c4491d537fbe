"""Cross-tokenizer alignment: where two tokenizers' tokens of a text end together, and how often ids meet.

Texts are cut at places where both tokenizers must end a token (``pieces.cut``),
so each different piece of a chunk of documents is aligned once.  A piece's
token ends are two ascending lists.  The shorter one drives a galloping search
into the longer: steps of 1, 2, 4 .. until an end is not smaller, then a binary
search inside the last step, for all pieces of the chunk side by side.  Ends
found in both lists are common and slice the piece into groups; the difference
between the ranks of neighbouring ends is the range of tokens that a token
overlaps, which gives the links.

Corpus-wide counts of id pairs are summed from one row per chunk and pair.
Their totals go back to the chunks that hold the pair, by join, and meet each
chunk's row in one call; no link becomes a row and nothing is collected.  A
chunk's row has megabytes, so row groups are kept to a few of them: memory
follows the chunk, not how many of them a file or task has.

Defined cases: a text that is null or empty, or whose tokens' bytes under either
tokenizer are not those of blank+text (a literal U+2581, say), has no tokens: its
counts are 0 and its groups the empty string, and it adds nothing to pair
counts.  Rows that repeat a doc_id each count; a null doc_id stays null; an empty
table gives no rows; columns other than ``doc_id`` and ``text`` are not read.
Strings that name special tokens are ordinary text.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lading.llm import pieces
from lading.llm.common import WIDE_ROWS, cogrouped, mapped, staged, worker_state

#: text of a chunk, in bytes: one row of pairs and one Python call; two fill an Arrow batch
CHUNK_BYTES = 4_400_000
#: a pair of ids is one integer: the first id above, the second below
SECOND = 2 ** 32

CHUNK_SCHEMA = ("chunk long, doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>,"
                " n_links array<bigint>, sha256 array<string>, groups array<string>, pairs array<bigint>, counts array<bigint>,"
                " pair_of_link binary, links_of_piece binary, pieces binary, pieces_end binary")
DOC_SCHEMA = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long,"
              " groups_sha256 string, groups string")


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class PieceLevel:
    """A sentencepiece model without text normalisation: ids of pieces that begin at a blank or beside a line feed.

    Its merges never join a blank to what stands before it, nor a line feed,
    which is a byte token, to anything; so many pieces go to it in one line.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.prefix = self.model.encode("\n")  # the blank it adds, the line feed
        self.feed = self.prefix[-1]

    def entries(self) -> list[bytes]:
        m = self.model
        return [bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode("utf-8")
                for i in range(m.get_piece_size())]

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``texts``, one after the other, and how many each has."""
        out: list = [None] * len(texts)
        plain = []
        for i, t in enumerate(texts):
            if b"\n" in t:
                out[i] = self.model.encode("\n" + t.decode("utf-8"))[len(self.prefix):]
            else:
                plain.append(i)
        for at in range(0, len(plain), pieces.LINE_PIECES):
            line = plain[at:at + pieces.LINE_PIECES]
            ids = self.model.encode("\n" + b"\n".join([texts[i] for i in line]).decode("utf-8"), num_threads=1)
            begin = len(self.prefix)
            for i in line:
                end = ids.index(self.feed, begin) if i != line[-1] else len(ids)
                out[i], begin = ids[begin:end], end + 1
        sizes = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter((x for ids in out for x in ids), np.uint32, int(sizes.sum())), sizes


class Vocabulary:
    """The bytes and the decimal digits of every id's entry."""

    def __init__(self, entries: list[bytes]):
        self.sizes = np.fromiter(map(len, entries), np.int64, len(entries))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(entries), np.uint8)
        self.width = len(str(len(entries) - 1)) + 1
        digits = "".join(str(i).rjust(self.width - 1, "\0") + "\0" for i in range(len(entries)))
        self.digits = np.frombuffer(digits.encode(), np.uint8).reshape(-1, self.width)

    def true(self, ids: np.ndarray, sizes: np.ndarray, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Whether the entries of each piece's ids are the piece: ``data`` holds the pieces from ``starts`` on."""
        made = pieces.gathered(self.bytes, self.starts[ids], self.sizes[ids])
        if len(made) == len(data) and np.array_equal(made, data):
            return np.ones(len(sizes), bool)
        made_of = np.concatenate([[0], np.cumsum(self.sizes[ids])])[np.concatenate([[0], np.cumsum(sizes)])]
        ends = np.append(starts[1:], len(data))
        return np.array([bytes(made[a:b]) == bytes(data[c:d])
                         for a, b, c, d in zip(made_of[:-1], made_of[1:], starts, ends)], bool)


def gallop(values: np.ndarray, longer: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """For each value the first place from ``begin`` on where ``longer`` is not smaller.

    ``longer`` ascends from each begin up to such a place, which must exist.
    """
    low, step, left = begin.copy(), 1, np.arange(len(values))
    high = begin.copy()
    while len(left):  # exponential steps
        at = begin[left] + step - 1
        np.minimum(at, len(longer) - 1, out=at)
        smaller = longer[at] < values[left]
        high[left] = at
        left = left[smaller]
        low[left] = at[smaller] + 1
        step *= 2
    left = np.flatnonzero(low < high)
    while len(left):  # binary search in the last step
        middle = (low[left] + high[left]) >> 1
        smaller = longer[middle] < values[left]
        low[left] = np.where(smaller, middle + 1, low[left])
        high[left] = np.where(smaller, high[left], middle)
        left = left[low[left] < high[left]]
    return low


def align(ends_a: np.ndarray, size_a: np.ndarray, ends_b: np.ndarray, size_b: np.ndarray):
    """Common ends and overlaps of many pairs of end lists, one pair after the other.

    Ends ascend over all lists, and a pair's last ends are equal.  Returns which
    tokens of either side end at a common place, and the links as three arrays:
    the pair of lists, and the tokens' places in either side.
    """
    first_a, first_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    common_a, common_b = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    links = []
    for drives, short, short_n, short_first, long, long_first, at_short, at_long, swap in (
            (size_a <= size_b, ends_a, size_a, first_a, ends_b, first_b, common_a, common_b, False),
            (size_a > size_b, ends_b, size_b, first_b, ends_a, first_a, common_b, common_a, True)):
        which = np.flatnonzero(drives & (short_n > 0))
        if not len(which):
            continue
        tokens = pieces.gathered(np.arange(len(short)), short_first[which], short_n[which])
        pair = np.repeat(which, short_n[which])
        found = gallop(short[tokens], long, long_first[pair])
        same = long[found] == short[tokens]
        at_short[tokens[same]] = True
        at_long[found[same]] = True
        # a token overlaps from where the one before it ended, one further if that end was common
        from_ = np.empty_like(found)
        from_[1:] = found[:-1] + same[:-1]
        heads = np.cumsum(short_n[which]) - short_n[which]
        from_[heads] = long_first[which]
        n = found - from_ + 1
        one, other = np.repeat(tokens, n), pieces.gathered(np.arange(len(long)), from_, n)
        links.append((np.repeat(pair, n), other, one) if swap else (np.repeat(pair, n), one, other))
    if not links:
        nothing = np.zeros(0, np.int64)
        return common_a, common_b, (nothing, nothing, nothing)
    return common_a, common_b, tuple(np.concatenate(side) for side in zip(*links))


def group_texts(vocab_a: Vocabulary, ids_a, size_a, common_a, vocab_b: Vocabulary, ids_b, size_b, common_b) -> list[bytes]:
    """Each piece's groups as ``a1,a2|b1;a3|b2,b3;``."""
    group_a, group_b = np.cumsum(common_a) - common_a, np.cumsum(common_b) - common_b
    groups = int(common_a.sum())
    before_a, before_b = (np.concatenate([[0], np.cumsum(np.bincount(g, minlength=groups))]) for g in (group_a, group_b))
    width = max(vocab_a.width, vocab_b.width)
    rows = np.zeros((len(ids_a) + len(ids_b), width), np.uint8)
    for vocab, ids, place, common, end in ((vocab_a, ids_a, np.arange(len(ids_a)) + before_b[group_a], common_a, b"|"),
                                           (vocab_b, ids_b, np.arange(len(ids_b)) + before_a[group_b + 1], common_b, b";")):
        written = vocab.digits[ids]
        written[:, -1] = np.where(common, end[0], b","[0])
        rows[place, width - vocab.width:] = written
    sizes = (rows != 0).sum(axis=1)
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(size_a + size_b)].tolist()
    flat = rows[rows != 0].tobytes()
    return [flat[a:b] for a, b in zip([0, *ends], ends)]


class Aligner:
    """Both tokenizers and what is known of their ids."""

    def __init__(self, path_a: str, path_b: str):
        self.ids_a, self.ids_b = pieces.TextIds(path_a), PieceLevel(path_b)
        self.vocab_a, self.vocab_b = Vocabulary(self.ids_a.encode.entries()), Vocabulary(self.ids_b.entries())

    def __call__(self, doc_ids, texts, with_groups: bool) -> list:
        """A chunk's columns, after its number, as in ``CHUNK_SCHEMA``."""
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = texts.fill_null("")
        nothing = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        data, offsets = pieces.joined(pc.binary_join_element_wise(pa.scalar("", texts.type), texts, pa.scalar(" ", texts.type)))
        starts = pieces.cut(data, offsets[:-1], marks=False)
        found, which = pieces.distinct(data, starts)
        piece_data, piece_ends = pieces.joined(found)
        piece_starts = piece_ends[:-1]
        ids_a, ends = self.ids_a(found)
        size_a = np.diff(ends, prepend=0)
        ids_b, size_b = self.ids_b(found.to_pylist())
        true = self.vocab_a.true(ids_a, size_a, piece_data, piece_starts) & self.vocab_b.true(ids_b, size_b, piece_data, piece_starts)
        if not true.all():  # such pieces have no tokens, nor have their documents
            ids_a, ids_b = ids_a[np.repeat(true, size_a)], ids_b[np.repeat(true, size_b)]
            size_a, size_b = np.where(true, size_a, 0), np.where(true, size_b, 0)
        common_a, common_b, (pair, a, b) = align(np.cumsum(self.vocab_a.sizes[ids_a]), size_a,
                                                 np.cumsum(self.vocab_b.sizes[ids_b]), size_b)
        written = group_texts(self.vocab_a, ids_a, size_a, common_a, self.vocab_b, ids_b, size_b, common_b)
        groups = np.add.reduceat(np.append(common_a, False), np.cumsum(size_a) - size_a, dtype=np.int64) * (size_a > 0) \
            if len(size_a) else np.zeros(0, np.int64)
        order = np.argsort(pair, kind="stable")
        links = np.bincount(pair, minlength=len(found))

        # documents: runs of pieces
        ends = np.searchsorted(starts, offsets[1:])
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        summed = lambda values: np.diff(np.concatenate([[0], np.cumsum(values[which])])[np.append(begins, ends[-1:])])
        real = ~nothing & (summed((~true).astype(np.int64)) == 0)
        take = written.__getitem__
        held = [b"".join(map(take, which[x:y].tolist()))[:-1] if ok else b"" for x, y, ok in zip(begins, ends, real)]
        sha = [hashlib.sha256(h).hexdigest() if h else "" for h in held]
        counted = which[np.repeat(real, ends - begins)]
        weight = np.repeat(np.bincount(counted, minlength=len(found)), links)
        pairs, of_link = np.unique(ids_a[a[order]].astype(np.int64) * SECOND + ids_b[b[order]], return_inverse=True)
        counts = np.bincount(of_link, weight, len(pairs)).astype(np.int64)
        long = lambda values: pa.array([values.tolist()], pa.list_(pa.int64()))
        raw = lambda values: pa.array([values.astype("<i4").tobytes()], pa.binary())
        per_doc = [long(np.where(real, summed(n), 0)) for n in (size_a, size_b, groups, links)]
        return [pa.array([doc_ids.to_pylist()], pa.list_(pa.int64())), *per_doc, pa.array([sha], pa.list_(pa.string())),
                pa.array([[h.decode() for h in held] if with_groups else None], pa.list_(pa.string())),
                long(pairs), long(counts), raw(of_link), raw(links), raw(counted), raw(np.cumsum(np.where(real, ends - begins, 0)))]


def _chunk_partition(path_a: str, path_b: str, with_groups: bool):
    names = [c.strip().split(" ")[0] for c in CHUNK_SCHEMA.split(",")]

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        aligner = worker_state(f"aligner {path_a} {path_b}", lambda: Aligner(path_a, path_b))
        chunk = TaskContext.get().partitionId() << 32
        for rows in pieces.slices(batches, 1, CHUNK_BYTES):
            columns = aligner(rows.column(0), rows.column(1), with_groups)
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), *columns], names=names)
            chunk += 1

    return run


def _count_chunk(chunk, totals):
    """A chunk's documents with the totals of their links; ``totals`` are (pair, total, best) in any order."""
    import pyarrow as pa

    names, kinds = [c.strip().split(" ")[0] for c in DOC_SCHEMA.split(",")], [pa.int64()] * 7 + [pa.string()] * 2
    told = totals.column("pair").to_numpy()
    order = np.argsort(told)
    told = told[order]
    found = [totals.column(name).to_numpy()[order].astype(np.int64) for name in ("best", "total")]
    out = []
    for row in chunk.to_batches(max_chunksize=1):
        of = lambda name: row.column(name)[0].values  # noqa: B023, E731  the one row's list
        of_link, links, which, ends = (np.frombuffer(row.column(c)[0].as_buffer(), "<i4")
                                       for c in ("pair_of_link", "links_of_piece", "pieces", "pieces_end"))
        place = np.searchsorted(told, of("pairs").to_numpy())
        heads = np.concatenate([[0], np.cumsum(links, dtype=np.int64)])
        docs = np.concatenate([[0], ends])
        sums = []
        for values in found:
            of_piece = np.diff(np.concatenate([[0], np.cumsum(values[place][of_link])])[heads])
            sums.append(pa.array(np.diff(np.concatenate([[0], np.cumsum(of_piece[which])])[docs]), pa.int64()))
        groups = of("groups") if row.column("groups")[0].is_valid else pa.nulls(len(ends), pa.string())
        values = [*map(of, ("doc_ids", "n_a", "n_b", "n_groups", "n_links")), *sums, of("sha256"), groups]
        out.append(pa.RecordBatch.from_arrays([v.cast(k) for v, k in zip(values, kinds)], names=names))
    return pa.Table.from_batches(out, pa.schema(list(zip(names, kinds))))


def aligned(docs: DataFrame, tokenizers: tuple[str, str] | None = None, with_groups: bool = False) -> DataFrame:
    """Per row of ``docs`` its digests (``DOC_SCHEMA``); ``groups`` holds the groups themselves if asked for.

    ``tokenizers`` are a byte-level file of the tokenizers library and a
    sentencepiece model without normalisation, which every executor has.
    """
    a, b = tokenizers or default_tokenizers()
    chunks = staged(mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
                           _chunk_partition(a, b, with_groups), CHUNK_SCHEMA, keep="aligner"), "align-chunks", "zstd", **WIDE_ROWS)
    held = (chunks.select("chunk", F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
            .select("chunk", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n")))
    # documents without tokens leave pairs that nothing counts
    totals = staged(held.groupBy("pair").agg(F.sum("n").alias("total")), "align-totals")
    second = F.col("pair").bitwiseAND(F.lit(SECOND - 1))
    most = totals.groupBy(second.alias("b")).agg(F.max("total").alias("most"))
    told = (totals.join(most, second == F.col("b"))
            .select("pair", "total", (F.col("total") == F.col("most")).cast("int").alias("best")))
    per_chunk = held.select(F.col("chunk").alias("_chunk"), "pair").join(told, "pair")
    return cogrouped(chunks.drop("counts"), "chunk", per_chunk, "_chunk", _count_chunk, DOC_SCHEMA)
