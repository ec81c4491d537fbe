"""Rows out to an endpoint: batches of JSON rows, each posted once.

The rows are cut into batches where they lie (no shuffle), by number and by
bytes, and the batches are written to the delivery's folder before anything is
sent; each gets an id and an idempotency key there.  They are then posted through
a ledger of answers in the same folder (``ledger``).  So a retried task, or the
same call after a lost job, sends the very same batches, only those without an
answer, and a batch whose answer was lost on its way goes out again under the
same ``Idempotency-Key``, by which the receiver knows it.

A folder stands for one delivery: another set of rows needs another folder.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, functions as F

from .. import session
from ..sources import formats
from .ledger import fetch_with_ledger

BATCH_ROWS = 500
BATCH_BYTES = 4 << 20
FORMATS = {"json": ("[", ",", "]", "application/json"), "lines": ("", "\n", "\n", "application/x-ndjson")}


def _batches(delivery: str, form: str, batch_rows: int, batch_bytes: int):
    head, between, tail, _ = FORMATS[form]

    def run(arrow):
        import pyarrow as pa
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0

        def batch(rows):
            name, body = f"{part}-{number}", head + between.join(rows) + tail
            key = hashlib.sha256(f"{delivery}/{name}/{body}".encode()).hexdigest()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([key]), pa.array([body]), pa.array([len(rows)], pa.int64())],
                                              names=["request_id", "key", "body", "n_rows"])

        rows, size = [], 0
        for b in arrow:
            for row in b.column(0).to_pylist():
                n = len(row.encode())
                if rows and (len(rows) == batch_rows or size + n > batch_bytes):
                    yield batch(rows)
                    rows, size, number = [], 0, number + 1
                rows.append(row)
                size += n
        if rows:
            yield batch(rows)

    return run


def post_rows(df: DataFrame, url: str, folder: str | None = None, form: str = "json", batch_rows: int = BATCH_ROWS,
              batch_bytes: int = BATCH_BYTES, headers: dict | None = None, on_failed: str = "raise",
              **fetch_options) -> DataFrame:
    """Post the rows of ``df`` to ``url``; returns ``request_id, n_rows, status, headers, body_text, ..`` a batch.

    A body is a JSON array of row objects, or with ``form="lines"`` one object a
    line; nulls are written.  A row above ``batch_bytes`` is a batch of its own.
    ``folder`` (default: a new one in staging) holds the batches and their
    answers; the same call with the same folder goes on where it stopped, and
    with no row of ``df`` nothing is sent.  A refused batch raises once all others
    are through, or with ``on_failed="row"`` is a row with its error.
    """
    if form not in FORMATS:
        raise ValueError(f"unknown form {form!r}; use one of {tuple(FORMATS)}")
    if on_failed not in ("raise", "row"):
        raise ValueError("on_failed must be 'raise' or 'row'")
    if batch_rows < 1:
        raise ValueError("batch_rows must be at least 1")
    spark = df.sparkSession
    folder = session.qualify(spark, folder or session.new_staging_dir(spark, "post")).rstrip("/")
    where = f"{folder}/batches"
    if not session.exists(spark, f"{where}/_SUCCESS"):  # nothing was sent before they are complete
        as_json = {"ignoreNullFields": "false", "timestampNTZFormat": formats.TS_NTZ_FORMAT, "timestampFormat": formats.TS_LTZ_FORMAT}
        (df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), as_json).alias("row"))
         .mapInArrow(_batches(uuid.uuid4().hex, form, batch_rows, batch_bytes), "request_id string, key string, body string, n_rows long")
         .write.mode("overwrite").parquet(where))
    sent = {"Content-Type": FORMATS[form][3], **(headers or {})}
    pairs = [F.lit(x) for kv in sent.items() for x in kv]
    batches = spark.read.parquet(where).select(
        "request_id", F.lit(url).alias("url"), F.lit("POST").alias("method"),
        F.create_map(*pairs, F.lit("Idempotency-Key"), F.col("key")).alias("headers"), "body", "n_rows")
    fetch_options.setdefault("chunk_rows", 1)  # an answer is in the ledger before the next batch goes out
    answers = fetch_with_ledger(batches, f"{folder}/answers", keep=("n_rows",), **fetch_options)
    if on_failed == "raise":
        bad = answers.where("error IS NOT NULL").agg(F.count(F.lit(1)).alias("n"), F.sum("n_rows").alias("rows"),
                                                     F.min(F.struct("request_id", "error")).alias("one")).first()
        if bad.n:
            raise RuntimeError(f"{bad.n} batches ({bad.rows} rows) were refused, e.g. {bad.one.request_id}: {bad.one.error}; "
                               f"the same call with folder={folder!r} sends the rest")
    return answers
