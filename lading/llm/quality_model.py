"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

Features are the hashed one- and two-word sequences of a text, over its words
and over their shapes (runs of capitals, small letters, digits and other signs;
a pair of equal words is told from other pairs), by the root of their count and
scaled to length one.  The FTRL-proximal learner goes through a sample of
labelled rows of at most about ``MAX_TRAIN`` documents and ``MAX_TRAIN_BYTES`` of
text, taken by a hash of the id and in hash order, as often as it takes to make
about ``STEPS`` updates; the driver receives their hashed features, never texts:
about 5 bytes for a byte of text, and at most 8 MB for one text of any length.
Every text is scored whole as a sparse dot product.

Defined cases: null and empty texts have the bias alone; rows without a label
are not learned from; a document with several label rows is learned once per
row; without labels, or with one class, scores are the bias's; rows that repeat
a doc_id are scored each; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lading.llm.common import spark_of, worker_state
from lading.llm.mixing import coin

BITS = 20
MAX_TRAIN = 10_000
MAX_TRAIN_BYTES = 48_000_000
STEPS = 20_000
MAX_EPOCHS = 20
ALPHA, BETA, L1, L2 = 2.0, 1.0, 1e-4, 1e-6
#: words whose shape a worker remembers before it starts anew
CACHE_WORDS = 300_000

#: capitals, small letters, digits and bytes beyond ASCII by class; other signs stay
CLASSES = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct feature indices of a text and their values; index 0 is the bias."""
    from xxhash import xxh3_64_intdigest

    runs, known = worker_state("word shapes", lambda: (re.compile(rb"(?s)(.)\1+"), {}))
    if len(known) > CACHE_WORDS:
        known.clear()
    words = (text or "").encode("utf-8").split()
    if not words:
        return np.zeros(1, np.int32), np.ones(1, np.float32)

    def pair(word):
        got = known.get(word)
        if got is None:
            shape = runs.sub(rb"\1", word.translate(CLASSES))
            got = known[word] = (xxh3_64_intdigest(word.lower()), xxh3_64_intdigest(shape, 1))
        return got

    both = np.array([pair(w) for w in words], np.uint64)
    n = len(words)
    h = np.empty((4, n), np.uint64)
    h[0], h[1] = both.T
    two = both[:-1] * np.uint64(0x9E3779B97F4A7C15) + both[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    two[:, 1] += (both[:-1, 0] == both[1:, 0]) * np.uint64(0x165667B19E3779F9)
    h[2:, :-1] = two.T
    h[2:, -1] = h[0, -1], h[1, -1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    index, count = np.unique((h >> np.uint64(64 - BITS)).astype(np.int32), return_counts=True)
    value = np.sqrt(count)
    value *= 1 / np.sqrt((value * value).sum())
    return np.concatenate([[0], index]).astype(np.int32), np.concatenate([[1], value]).astype(np.float32)


def _feature_partition(batches):
    import pyarrow as pa

    for b in batches:
        found = [features(t) for t in b.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([i.tobytes() for i, _ in found], pa.binary()),
                                          pa.array([x.tobytes() for _, x in found], pa.binary()), b.column(1), b.column(2)],
                                         names=["idx", "val", "label", "ord"])


def fit(examples) -> np.ndarray:
    """FTRL-proximal weights from (indices, values, label) examples in their order."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(at):
        big = np.abs(z[at]) > L1
        return np.where(big, -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2), 0.0)

    for idx, x, label in examples:
        w = weights(idx)
        g = (1 / (1 + np.exp(-(w @ x))) - label) * x
        grown = np.sqrt(n[idx] + g * g)
        z[idx] += g - (grown - np.sqrt(n[idx])) / ALPHA * w
        n[idx] += g * g
    return weights(np.arange(1 << BITS)).astype(np.float32)


def sample_rate(rows: DataFrame, max_train: int = MAX_TRAIN, max_bytes: int = MAX_TRAIN_BYTES) -> float:
    """The share of ``rows`` (with their ``text``, or its ``size`` in bytes) that is expected to keep both bounds."""
    size = F.col("size") if "text" not in rows.columns else F.octet_length("text").cast("long")
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return min(1.0, max_train / max(n, 1), max_bytes / max(size, 1))


def train(labelled: DataFrame, max_train: int = MAX_TRAIN, steps: int = STEPS, max_bytes: int = MAX_TRAIN_BYTES,
          marks: DataFrame | None = None) -> np.ndarray:
    """Weights from ``doc_id, text, label`` rows, label 0 or 1.

    With ``marks`` (``doc_id, label``) the first are ``doc_id, text`` rows, joined with
    them by id: sizes are joined for the rate, then the sample's marks are broadcast
    to the texts, so that no text is shuffled.
    """
    order = coin(F.col("doc_id"), "quality-sample")
    if marks is None:
        rows = labelled.where("label IN (0, 1)")
        rows = rows.where(order < sample_rate(rows, max_train, max_bytes))
    else:
        marks = marks.where("label IN (0, 1)")
        sizes = labelled.select("doc_id", F.octet_length("text").cast("long").alias("size"))
        taken = order < sample_rate(sizes.join(marks, "doc_id"), max_train, max_bytes)
        # marks that have a document, by ids alone: about as many as the sample has rows
        found = marks.where(taken).join(labelled.select("doc_id").where(taken), "doc_id", "left_semi")
        rows = labelled.select("doc_id", "text").where(taken).join(F.broadcast(found), "doc_id")
    sample = rows.select("text", F.col("label").cast("int").alias("label"), order.alias("ord"))
    got = sample.mapInArrow(_feature_partition, "idx binary, val binary, label int, ord double").toArrow()
    seen = sorted(zip(*(got.column(c).to_pylist() for c in ("ord", "label", "idx", "val"))))
    epochs = min(MAX_EPOCHS, -(-steps // max(1, len(seen))))
    return fit((np.frombuffer(i, np.int32), np.frombuffer(x, np.float32), y)
               for _ in range(epochs) for _, y, i, x in seen)


def _score_partition(shared):
    def run(batches):
        import pyarrow as pa

        w = shared.value
        for b in batches:
            dots = np.array([w[i] @ x for i, x in map(features, b.column(1).to_pylist())], float)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(1 / (1 + np.exp(-dots)), pa.float64())],
                                             names=["doc_id", "score"])

    return run


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id, score`` of every row of ``docs``, from its text alone."""
    shared = spark_of(docs).sparkContext.broadcast(weights)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(_score_partition(shared), "doc_id long, score double"))
