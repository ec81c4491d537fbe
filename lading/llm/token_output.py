"""Token-id output: documents as Simple-8b pages, in ascending doc_id order.

Documents are range-partitioned and sorted by id; each task encodes its range
and writes pages, a page holding whole documents (a document longer than a page
has one of its own, which decodes block by block).  A shard is one task's range,
so shards, pages and documents follow each other in id order, and a document's
global start is its shard's offset plus its place there.  Pages are rows of a
Parquet table: Spark's commit protocol makes a retried task's output appear
once.

Defined cases: a null text is empty and still has its end id; a null doc_id
sorts first; rows that repeat a doc_id are all written, by text; an empty table
writes no pages; columns other than ``doc_id`` and ``text`` are not written.
Strings that name special tokens are ordinary text (the tokenizer's
``encode_special_tokens`` is set, which is not the library's default).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lading import session
from lading.llm import pieces, simple8b
from lading.llm.common import mapped, small, spark_of, worker_state

END_ID = 0
PAGE_IDS = 131_072
#: text that a task encodes at once
SLICE_BYTES = 2_000_000

PAGE_SCHEMA = "shard int, start_in_shard long, n_ids long, doc_ids array<bigint>, lengths array<bigint>, payload binary"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def tokenizer_of(path: str) -> pieces.TextIds:
    """The worker's tokenizer with its table of pieces (bounded: ``pieces.TABLE_BITS``)."""
    return worker_state(f"tokenizer {path}", lambda: pieces.TextIds(path))


def token_bytes(texts: list[str], path: str) -> list[bytes]:
    """Each text's ids as little-endian u32."""
    import pyarrow as pa

    ids, ends = tokenizer_of(path)(pa.array(texts, pa.string()))
    raw, ends = ids.astype("<u4").tobytes(), (4 * ends).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def ended_ids(texts, path: str, end_id: int):
    """Ids of an Arrow string array, the end id behind each text's, and where each text ends."""
    import numpy as np

    ids, ends = tokenizer_of(path)(texts)
    return np.insert(ids, ends, end_id).astype("<u4", copy=False), ends + np.arange(1, len(ends) + 1)


def _encode_partition(path: str, end_id: int, page_ids: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        schema = pa.schema([("shard", pa.int32()), ("start_in_shard", pa.int64()), ("n_ids", pa.int64()),
                            ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                            ("payload", pa.binary())])
        shard, start = TaskContext.get().partitionId(), 0
        doc_ids, lengths, parts, size = [], [], [], 0

        def page():
            nonlocal start, doc_ids, lengths, parts, size
            out = pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([start], pa.int64()), pa.array([size], pa.int64()),
                pa.array([doc_ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())),
                pa.array([simple8b.encode(np.concatenate(parts))], pa.binary())], schema=schema)
            start, doc_ids, lengths, parts, size = start + size, [], [], [], 0
            return out

        for rows in pieces.slices(batches, 1, SLICE_BYTES):
            ended, ends = ended_ids(rows.column(1), path, end_id)
            n, ids_of, done = len(ends), rows.column(0).to_pylist(), 0
            while done < n:  # whole documents up to a full page
                begin = int(ends[done - 1]) if done else 0
                last = min(int(np.searchsorted(ends, begin + page_ids - size)), n - 1)
                stop = int(ends[last])
                doc_ids += ids_of[done:last + 1]
                lengths += np.diff(ends[done:last + 1], prepend=begin).tolist()
                parts.append(ended[begin:stop])
                size, done = size + stop - begin, last + 1
                if size >= page_ids:
                    yield page()
        if doc_ids:
            yield page()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID,
                 page_ids: int = PAGE_IDS) -> None:
    """Write the token ids of ``docs`` to ``path``; ``tokenizer`` is a file every executor has."""
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
               .repartitionByRange(F.col("doc_id").asc_nulls_first())
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()))
    run = _encode_partition(tokenizer or default_tokenizer(), end_id, page_ids)
    mapped(ordered, run, PAGE_SCHEMA, keep="tokenizer").write.parquet(path)


def _decode_pages(batches):
    import numpy as np
    import pyarrow as pa

    schema = pa.schema([("doc_id", pa.int64()), ("shard", pa.int32()), ("at", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids", pa.binary())])
    for b in batches:
        for row in b.to_pylist():
            ids = simple8b.decode(row["payload"]).astype("<u4")
            lengths = np.array(row["lengths"], np.int64)
            ends = np.cumsum(lengths)
            raw = memoryview(ids.tobytes())
            yield pa.RecordBatch.from_arrays([
                pa.array(row["doc_ids"], pa.int64()), pa.array([row["shard"]] * len(lengths), pa.int32()),
                pa.array(row["start_in_shard"] + ends - lengths, pa.int64()), pa.array(lengths, pa.int64()),
                pa.array([bytes(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())], pa.binary())],
                schema=schema)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` from written pages; ``ids`` are little-endian u32 bytes.

    ``start`` counts the ids of all documents before.  The only table that is
    summed in order has one row per shard.
    """
    pages = spark.read.schema(PAGE_SCHEMA).parquet(path)
    shards = pages.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    offsets = shards.select(F.col("shard").alias("_shard"), F.coalesce(
        F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    docs = mapped(pages, _decode_pages, "doc_id long, shard int, at long, n_tokens long, ids binary")
    return (docs.join(small(offsets), F.col("shard") == F.col("_shard"))
            .select("doc_id", (F.col("offset") + F.col("at")).alias("start"), "n_tokens", "ids"))


def tokenized(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write ``docs`` as pages to the shared staging folder and read them back."""
    spark = spark_of(docs)
    path = session.new_staging_dir(spark, "llm-tokens")
    write_tokens(docs, path, tokenizer)
    return read_tokens(spark, path)
