import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_SMALL
from corpus_fixtures import docs_of, odd, prose  # noqa: F401
from pyspark.sql import functions as F

from lading.llm import alignment, packing, pieces, queries, token_output, vector_codes
from lading.llm.common import staged, table


def random_texts(n, seed):
    rng = random.Random(seed)
    parts = ["ab", "word", "Hello", " ", " ", "  ", "\n", "\n", "'", "'s", "!", ".", "é", " ", "　", "1", "字", "\t", "\r",
             "(", "S", "'ve", "\x85", "😀", "<|endoftext|>", "\x00"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def byte_tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_output.default_tokenizer())
    t.encode_special_tokens = True
    return t


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


# pieces

def test_pieces_of_random_texts(byte_tokenizer):
    import pyarrow as pa

    encode = pieces.TextIds(token_output.default_tokenizer())
    for seed in (1, 2):  # the second time with pieces met before
        texts = [*random_texts(4000, seed), None, "", "x" * 3000, *random_texts(500, 1)]
        ids, ends = encode(pa.array(texts, pa.string()))
        got = [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)]
        assert got == [ids_of(byte_tokenizer, t) for t in texts]


def test_a_full_table_forgets_but_stays_right(byte_tokenizer, monkeypatch):
    import pyarrow as pa

    encode = pieces.TextIds(token_output.default_tokenizer())
    encode.table = pieces.Table(bits=4)
    for seed in range(3):
        texts = [prose(40, s) for s in range(seed, seed + 30)]
        ids, ends = encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)] == [ids_of(byte_tokenizer, t) for t in texts]


def test_no_text_is_no_ids():
    import pyarrow as pa

    ids, ends = pieces.TextIds(token_output.default_tokenizer())(pa.array([None, "", None], pa.string()))
    assert len(ids) == 0 and ends.tolist() == [0, 0, 0]


# packing

def best_fit(lengths, size, most):
    """Bounded best fit with a plain list of bins."""
    open_bins, closed = [], []
    for i, n in enumerate(lengths):
        fits = [b for b in open_bins if b[0] >= n]
        if fits:
            one = min(fits, key=lambda b: b[0])
        else:
            if len(open_bins) == most:
                fullest = min(open_bins, key=lambda b: b[0])
                open_bins.remove(fullest)
                closed.append(fullest)
            one = [size, []]
            open_bins.append(one)
        one[0] -= n
        one[1].append(i)
        if not one[0]:
            open_bins.remove(one)
            closed.append(one)
    return closed, open_bins


def test_bins_are_a_best_fit():
    rng = random.Random(7)
    for most in (1, 3, 50):
        lengths = [rng.randint(1, 64) for _ in range(800)]
        bins, closed = packing.Bins(64, most), []
        for i, n in enumerate(lengths):
            closed += bins.put(n, i)
            assert bins.open <= most
        want, still_open = best_fit(lengths, 64, most)
        fill = lambda some: sorted(sum(lengths[i] for i in b) for b in some)  # noqa: E731  (equally full bins may swap)
        assert fill(closed) == fill([b[1] for b in want])
        assert fill([b for b, _ in bins.rest()]) == fill([b[1] for b in still_open])
        assert sorted(i for b in [*closed, *(b for b, _ in bins.rest())] for i in b) == list(range(800))


def check_packing(docs, rows, size, byte_tokenizer):
    texts = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        texts[r.doc_id].append(np.array([*ids_of(byte_tokenizer, r.text), 0], "<u4"))
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for r in rows.collect():
        assert 0 < r.length <= size
        sequences[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append((r.piece, r.start, r.length, r.crc))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    want = defaultdict(list)
    for doc_id, each in texts.items():
        for ids in each:
            first = len(ids) % size or size
            cuts = [0, *range(first, len(ids) + 1, size)]
            want[doc_id] += [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert {d: sorted(p) for d, p in by_doc.items()} == {d: sorted(p) for d, p in want.items()}
    return len(sequences), sum(len(i) for each in texts.values() for i in each)


def test_packing_odd_rows(odd, docs_of, byte_tokenizer):  # noqa: F811
    rows = packing.pack(odd).withColumn("crc", F.crc32("ids"))
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset", "crc"]
    check_packing(odd, rows, 2048, byte_tokenizer)
    assert packing.pack(docs_of([])).count() == 0
    small = packing.pack(odd, size=7, open_bins=2).withColumn("crc", F.crc32("ids"))
    check_packing(odd, small, 7, byte_tokenizer)


def test_packing_of_the_table(spark, byte_tokenizer):
    docs = table(spark, SF_SMALL, "documents")
    rows = queries.QUERIES["op11_best_fit_packing"](spark, SF_SMALL).withColumnRenamed("ids_crc32", "crc")
    n, ids = check_packing(docs, rows, 2048, byte_tokenizer)
    assert n <= math.ceil(ids / 2048) * 1.02 + 1


def test_many_small_tasks_are_packed_again(docs_of, byte_tokenizer):  # noqa: F811
    docs = docs_of([(i, prose(20 + i % 50, i)) for i in range(600)], partitions=40)
    rows = packing.pack(docs).withColumn("crc", F.crc32("ids"))
    n, ids = check_packing(docs, rows, 2048, byte_tokenizer)
    assert n <= math.ceil(ids / 2048) * 1.02 + 1
    first = sorted(map(tuple, rows.drop("ids").collect()))
    assert sorted(map(tuple, rows.drop("ids").collect())) == first  # read again: the same sequences


# alignment

@pytest.fixture(scope="module")
def aligner():
    made = alignment.Aligner(*alignment.default_tokenizers())
    made.entries = made.ids_a.encode.entries(), made.ids_b.entries()
    return made


def brute_alignment(text, byte_tokenizer, aligner):
    """(n_a, n_b, groups, links) of a text, token by token."""
    if not text:
        return 0, 0, [], []
    sides = []
    for ids, vocab in zip((ids_of(byte_tokenizer, " " + text), aligner.ids_b.model.encode(text)), aligner.entries):
        side, at = [], 0
        for i in ids:
            side.append((at, at + len(vocab[i]), i))
            at += len(vocab[i])
        if b"".join(vocab[i] for i in ids) != (" " + text).encode():
            return 0, 0, [], []
        sides.append(side)
    a, b = sides
    common, low, groups = sorted({t[1] for t in a} & {t[1] for t in b}), 0, []
    for end in common:
        groups.append("|".join(",".join(str(i) for _, e, i in side if low < e <= end) for side in sides))
        low = end
    return len(a), len(b), groups, [(i, j) for s, e, i in a for t, f, j in b if s < f and t < e]


def check_alignment(docs, rows, byte_tokenizer, aligner):
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    each = [brute_alignment(t, byte_tokenizer, aligner) for _, t in texts]
    count = Counter(link for *_, links in each for link in links)
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    want = []
    for (doc_id, _), (n_a, n_b, groups, links) in zip(texts, each):
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        want.append((doc_id, n_a, n_b, len(groups), len(links), sum(count[x] == most[x[1]] for x in links),
                     sum(count[x] for x in links), sha))
    got = rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_gallop_finds_what_a_binary_search_does():
    rng = np.random.default_rng(3)
    longer = np.cumsum(rng.integers(1, 9, 5000))
    values = rng.integers(0, longer[-1], 3000)
    begin = np.searchsorted(longer, np.maximum(values - rng.integers(0, 4000, 3000), 0))
    assert np.array_equal(alignment.gallop(values, longer, begin), np.searchsorted(longer, values))


def test_alignment_of_odd_and_random_texts(odd, docs_of, byte_tokenizer, aligner, monkeypatch):  # noqa: F811
    plain = odd.where("doc_id <> 5 OR doc_id IS NULL")  # brute force is quadratic
    check_alignment(plain, alignment.aligned(plain), byte_tokenizer, aligner)
    assert alignment.aligned(docs_of([])).count() == 0
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 900)  # counts meet over many chunks
    texts = [*random_texts(600, 5), "▁ literal", "a ▁ b", "<s> x </s>", "<0x41>", "b" * 900, *[prose(30, s % 5) for s in range(60)]]
    docs = docs_of([(i % 640, t) for i, t in enumerate(texts)], partitions=5)
    rows = alignment.aligned(docs, with_groups=True)
    check_alignment(docs, rows, byte_tokenizer, aligner)
    want = sorted(";".join(brute_alignment(t, byte_tokenizer, aligner)[2]) for t in texts)
    assert sorted(r.groups for r in rows.collect()) == want


def test_many_chunks_of_a_task_share_no_row_group(docs_of, monkeypatch):
    """Memory follows a chunk's row, not how many chunks a task has."""
    import pyarrow.parquet as pq

    kept = []
    monkeypatch.setattr(alignment, "staged", lambda df, label, *a, **k: kept.append((label, out := staged(df, label, *a, **k))) or out)
    letter = "char(97 + pmod(hash({}), 26))"
    words = f"transform(sequence(1, 1000000), i -> {letter.format('i, doc_id')} || {letter.format('doc_id, i')})"
    docs = docs_of([(i, "") for i in range(16)], partitions=1).withColumn("text", F.expr(f"array_join({words}, ' ')"))
    rows = alignment.aligned(docs).collect()
    assert len(rows) == 16 and all(r.n_links == r.n_a + r.n_b - r.n_groups and r.n_links >= 1_000_000 for r in rows)
    files = [f for label, df in kept if label == "align-chunks" for f in df.inputFiles()]
    groups = [m.row_group(i) for f in files for m in [pq.ParquetFile(f.removeprefix("file://")).metadata] for i in range(m.num_row_groups)]
    assert len(groups) > 1 and max(g.total_byte_size for g in groups) < 50 << 20


def test_chunks_without_tokens_stay(docs_of):
    docs = docs_of([(1, None), (1, ""), (None, None)], partitions=3)
    assert sorted(map(tuple, alignment.aligned(docs).collect()), key=repr) == \
        sorted([(1, 0, 0, 0, 0, 0, 0, "", None)] * 2 + [(None, 0, 0, 0, 0, 0, 0, "", None)], key=repr)


def test_long_text_keeps_its_links(odd, byte_tokenizer, aligner):  # noqa: F811
    """Without all pairs: links of two lists are their lengths less the common ends."""
    got = alignment.aligned(odd).where("doc_id = 5").first()
    assert got.n_links == got.n_a + got.n_b - got.n_groups
    assert got.n_a == len(ids_of(byte_tokenizer, " " + odd.where("doc_id = 5").first().text))


def test_alignment_of_the_table(spark, byte_tokenizer, aligner):
    docs = table(spark, SF_SMALL, "documents").where("length(text) < 1500")
    check_alignment(docs, alignment.aligned(docs), byte_tokenizer, aligner)


# vector codes

def brute_codes(rows, parts=8, entries=16, rounds=6):
    """(vec_id, label, code, error) and codebooks, in Python integers."""
    kept = [(v, lab, [math.floor(4096 * float(np.float32(c))) for c in e]) for v, e, lab in rows
            if e is not None and all(c is not None and math.isfinite(c) for c in e)]
    width = max(-(-max((len(x) for *_, x in kept), default=0) // parts), 1)
    kept = [(v, lab, x + [0] * (parts * width - len(x))) for v, lab, x in kept]
    cut = lambda x, p: x[p * width:(p + 1) * width]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[cut(r[2], p) for r in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            members = defaultdict(list)
            for *_, x in kept:
                members[nearest(cut(x, p), book)[1]].append(cut(x, p))
            books[p] = [[sum(c) // len(members[e]) for c in zip(*members[e])] if e in members else entry for e, entry in enumerate(book)]
    out = []
    for v, lab, x in kept:
        found = [nearest(cut(x, p), books[p]) for p in range(parts)]
        out.append((v, lab, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    return out, books


VECTORS = "label int, vec_id long, embedding array<float>, part string, n string, member string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(lab, v, e, "x", "y", "z") for v, e, lab in rows], VECTORS).repartition(3)


def check_codes(spark, rows, **how):
    coded, books = vector_codes.codes(vectors_of(spark, rows), **how)
    want, want_books = brute_codes(rows, **how)
    assert sorted(map(tuple, coded.select("vec_id", "label", "code", "error").collect()), key=repr) == sorted(want, key=repr)
    assert books.tolist() == want_books
    total = Counter()
    for _, lab, _, error in want:
        total[lab] += error
    got = vector_codes.with_label_error(coded).collect()
    assert len(got) == len(want) and all(r.label_error == total[r.label] for r in got)


def test_codes_of_odd_vectors(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=16).tolist(), int(i % 3) if i % 4 else None) for i in range(120)]
    rows += [(200 + i, [0.25] * 16, 1) for i in range(60)]  # ties and a hot vector
    rows += [(3, rng.normal(size=16).tolist(), 1), (3, [0.25] * 16, None), (None, [0.5] * 16, 2), (None, None, None),
             (-5, None, 1), (-4, [float("nan")] * 16, 1), (-3, [float("inf")] + [0.0] * 15, 1), (-2, [None] + [0.0] * 15, 1),
             (-1, [], 0), (500, [1.0, -1.0, 2.0], 0)]
    monkeypatch.setattr(vector_codes, "RESIDENT", 20)  # several owners an entry
    check_codes(spark, rows)
    check_codes(spark, rows, parts=3, entries=5, rounds=2)


def test_codes_of_few_vectors(spark):
    check_codes(spark, [(i, [0.1 * i] * 8, None) for i in range(5)])
    check_codes(spark, [(1, None, 1)])
    coded, books = vector_codes.codes(vectors_of(spark, [(1, None, 1)]))
    assert coded.count() == 0 and books.shape == (8, 0, 1)


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(2)
    check_codes(spark, [(i, (rng.normal(size=8) * 60_000).tolist(), 0) for i in range(40)])
    x = np.array([[2 ** 31]], np.int64)
    with pytest.raises(OverflowError):
        vector_codes.nearest(x, x)


def test_codes_of_the_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, SF_SMALL, "embeddings").collect()]
    check_codes(spark, rows)
