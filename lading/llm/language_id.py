"""Language identification by error-correcting output codes.

Every learned language has a codeword of +1/-1 bits.  For each bit a binary
classifier over hashed byte n-grams (log-odds of the languages with the bit set
against the others) gives a margin; decoding sums a logistic loss per codeword,
each bit weighted by how far apart its two sides are, and takes the codeword
with the least.  The score is the soft-min over codewords; a document whose
best and second codeword are close is flagged ambiguous.

Training counts n-grams over a sample of labelled rows, at most about
``MAX_DOCS_PER_LANG`` per language by a hash of the id; the counts are summed by
Spark and the driver gets one row per language and bucket at most.  Texts are
scored whole, in slices of bounded size; the margins of a longer text are summed
over pieces of it.

Defined cases: a null text or one without a letter is ``und`` with score 0 and
ambiguous; with no learned language every text is ``und``; with one, every text
with a letter is that language; rows that repeat a doc_id are scored each; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lading.llm.common import mapped, spark_of
from lading.llm.mixing import coin

MAX_DOCS_PER_LANG = 4000
NGRAMS = (2, 3, 4)
BUCKET_BITS = 16
SLICE_BYTES = 1_000_000
#: ambiguous: the best score leads the second by less
LEAD = 0.1
UND = "und"

#: ASCII letters to lower case, other ASCII to a space, bytes beyond ASCII stay
FOLD = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
PAD = max(NGRAMS) - 1


def pieces(texts, most: int = SLICE_BYTES):
    """Runs of (number of the text, folded bytes) of under about 2 * ``most`` bytes.

    A longer text goes in pieces of ``most`` bytes and the ``PAD`` bytes behind.
    """
    run, size = [], 0
    for i, t in enumerate(texts):
        raw = b" " + t.lower().encode("utf-8").translate(FOLD) + b" " * PAD
        for at in range(0, len(raw) - PAD, most):
            run.append((i, raw[at:at + most + PAD]))
            size += len(run[-1][1])
            if size >= most:
                yield run
                run, size = [], 0
    if run:
        yield run


def buckets(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the pieces, one row per n, and where each piece starts.

    The last ``PAD`` places of a piece, padding or the next piece's, get the extra bucket.
    """
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
    ends = np.cumsum([len(r) for r in raw])
    starts = ends - [len(r) for r in raw]
    code, out = data, np.empty((len(NGRAMS), len(data)), np.uint32)
    for n in range(2, max(NGRAMS) + 1):
        code = code << np.uint32(8)
        code[:-(n - 1)] |= data[n - 1:]
        if n in NGRAMS:
            h = (code + np.uint32(n * 0x51ED27)) * np.uint32(0x9E3779B1)
            out[NGRAMS.index(n)] = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(32 - BUCKET_BITS)
    for back in range(1, PAD + 1):
        out[:, ends - back] = 1 << BUCKET_BITS
    return out, starts


def slices(rows, most: int = SLICE_BYTES):
    """Runs of (key, text) of at most about ``most`` characters."""
    run, size = [], 0
    for row in rows:
        run.append(row)
        size += len(row[1])
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """A k x L matrix of +1/-1: all distinct splits up to 7 languages, random dense codes beyond."""
    if k == 1:
        return np.ones((1, 1))
    if k <= 7:
        rest = [s for size in range(k - 1) for s in combinations(range(1, k), size)]
        return np.array([[1 if i == 0 or i in s else -1 for s in rest] for i in range(k)], float)
    rng, length, best, far = np.random.default_rng(seed), max(15, math.ceil(10 * math.log2(k))), None, -1
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], (k, length))
        code = code[:, np.abs(code.sum(axis=0)) < k]
        gram = code @ code.T - 2 * length * np.eye(k)
        apart = (code.shape[1] - gram.max()) / 2
        if apart > far:
            best, far = code, apart
    return best


def _count_partition(batches):
    """(lang, bucket, n) of the texts of a partition."""
    import pyarrow as pa

    size = (1 << BUCKET_BITS) + 1
    counts: dict[str, np.ndarray] = {}
    for b in batches:
        for run in slices(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
            by_lang: dict[str, list[str]] = {}
            for lang, text in run:
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                for some in pieces(texts):
                    got = np.bincount(buckets([raw for _, raw in some])[0].ravel(), minlength=size)
                    counts[lang] = counts.get(lang, 0) + got
    for lang, got in counts.items():
        at = np.flatnonzero(got[:-1])
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at, pa.int64()), pa.array(got[at], pa.int64())],
                                         names=["lang", "bucket", "n"])


def train(labelled: DataFrame, max_docs_per_lang: int = MAX_DOCS_PER_LANG) -> dict | None:
    """A model from ``doc_id, text, lang`` rows; None if there is no labelled text."""
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    have = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not have:
        return None
    rate = F.lit(1.0)
    for lang, n in sorted(have.items()):
        if n > max_docs_per_lang:
            rate = F.when(F.col("lang") == lang, max_docs_per_lang / n).otherwise(rate)
    sample = rows.where(coin(F.col("doc_id"), "lang-sample") < rate).select("lang", "text")
    sums = (mapped(sample, _count_partition, "lang string, bucket long, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    langs = sorted(set(sums.column("lang").to_pylist()))
    if not langs:
        return None
    index = {lang: i for i, lang in enumerate(langs)}
    freq = np.zeros((len(langs), 1 << BUCKET_BITS))
    freq[[index[x] for x in sums.column("lang").to_pylist()], sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    total = freq.sum(axis=1, keepdims=True)
    freq = freq / total + 0.5 / np.median(total)  # an n-gram that no language has says nothing
    code = codewords(len(langs))
    weights = np.zeros(((1 << BUCKET_BITS) + 1, code.shape[1]), np.float32)
    trust = np.ones(code.shape[1])
    if len(langs) > 1:
        for b in range(code.shape[1]):
            yes, no = freq[code[:, b] > 0].mean(axis=0), freq[code[:, b] < 0].mean(axis=0)
            weights[:-1, b] = np.log(yes / no)
            trust[b] = ((yes - no) * np.log(yes / no)).sum()  # symmetric divergence of the two sides
        trust /= trust.mean()
    return {"langs": langs, "code": code, "weights": weights, "trust": trust}


def scores(texts: list[str], model: dict) -> np.ndarray:
    """Soft-min score of every language for each text."""
    weights = model["weights"]
    total, n = np.zeros((len(texts), weights.shape[1])), np.full(len(texts), PAD)
    for some in pieces(texts):
        which, raw = [i for i, _ in some], [r for _, r in some]
        places, starts = buckets(raw)
        np.add.at(total, which, sum(np.add.reduceat(weights[row], starts, axis=0) for row in places))
        np.add.at(n, which, [len(r) - PAD for r in raw])
    margin = total / np.sqrt(n * len(NGRAMS))[:, None]
    loss = np.logaddexp(0, -margin[:, None, :] * model["code"][None]) @ model["trust"]
    best = np.exp(loss.min(axis=1, keepdims=True) - loss)
    return best / best.sum(axis=1, keepdims=True)


def _predict_partition(model, lead: float):
    def run(batches):
        import pyarrow as pa

        m = model.value
        schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
                            ("ambiguous", pa.bool_())])
        for b in batches:
            for some in slices((i, t or "") for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                ids, texts = [i for i, _ in some], [t for _, t in some]
                known = np.array([m is not None and any(map(str.isalpha, t)) for t in texts])
                lang, score, close = [UND] * len(ids), np.zeros(len(ids)), np.ones(len(ids), bool)
                at = np.flatnonzero(known)
                if len(at):
                    got = scores([texts[i] for i in at], m)
                    order = np.sort(got, axis=1)
                    score[at] = order[:, -1]
                    close[at] = order[:, -1] - (order[:, -2] if got.shape[1] > 1 else 0) < lead
                    for i, c in zip(at, got.argmax(axis=1)):
                        lang[i] = m["langs"][c]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lang, pa.string()),
                                                  pa.array(score), pa.array(close)], schema=schema)

    return run


def predict(docs: DataFrame, model: dict | None, lead: float = LEAD) -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` of every row of ``docs``, from its text alone."""
    shared = spark_of(docs).sparkContext.broadcast(model)
    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _predict_partition(shared, lead),
                  "doc_id long, lang_pred string, score double, ambiguous boolean")


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part`` (a null id is never held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def keep_identified(docs: DataFrame, model: dict | None, lead: float = LEAD) -> DataFrame:
    """``docs`` without the rows that have no letter or whose language is ambiguous, same columns."""
    shared = spark_of(docs).sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        judge = _predict_partition(shared, lead)
        for b in batches:
            text = b.column(b.schema.get_field_index("text"))
            rows = pa.RecordBatch.from_arrays([pa.array(range(len(text)), pa.int64()), text], names=["doc_id", "text"])
            kept = [not x for part in judge([rows]) for x in part.column("ambiguous").to_pylist()]
            yield b.filter(pa.array(kept, pa.bool_()))

    return mapped(docs, run, docs.schema)
