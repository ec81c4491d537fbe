"""A fetch that can be resumed: answers go to a ledger as they come.

Every answer is appended to the ledger folder by the task that got it, in files
of at most ``chunk_rows`` answers, before it goes on.  A job that is lost half
way, or run again, reads the ledger first and sends only the requests that it
does not hold an answer of.  A request is known by its id, URL, method, headers
and body together; equal requests are sent once and all get the answer.

An answer is final when the request succeeded or was refused for good; failures
that may pass (no connection, 408, 429, 5xx) are kept too, so that the result
has a row for them, but sent again by the next run.  Between an answer and its
place in the ledger lie at most the answers of one chunk, so a lost task repeats
no more than those.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F, types as T

from .. import session
from . import objects
from .fetch import fetch_requests, response_schema

LEDGER = T.StructType([T.StructField("request_key", T.StringType()), *response_schema().fields[1:],
                       T.StructField("run", T.LongType())])


def request_key(requests: DataFrame):
    """One name for all that is sent and the id it is sent for."""
    have = [c for c in ("request_id", "url", "method", "headers", "body") if c in requests.columns]
    as_text = [F.to_json(F.array_sort(F.map_entries(c))).alias(c) if c == "headers" else F.col(c) for c in have]
    return F.sha1(F.to_json(F.struct(*as_text), {"ignoreNullFields": "false"}))


def final():
    """Whether an answer needs no other try."""
    return F.col("error").isNull() | (F.col("status").isNotNull() & (F.col("status") < 500) & ~F.col("status").isin(408, 429))


def _append(folder: str, run: int):
    """Every batch of answers becomes a file of the ledger."""
    def log(batch):
        import io

        import pyarrow as pa
        import pyarrow.parquet as pq

        if batch.num_rows:
            out = io.BytesIO()
            runs = pa.array([run] * batch.num_rows, pa.int64())
            pq.write_table(pa.Table.from_arrays([*batch.columns, runs], names=[f.name for f in LEDGER.fields]), out)
            objects.write_bytes(f"{folder}/{uuid.uuid4().hex}.parquet", out.getvalue())

    return log


def answers(spark, ledger: str) -> DataFrame:
    """One row per request key of a ledger: its final answer, else its latest one."""
    rows = spark.read.schema(LEDGER).option("pathGlobFilter", "*.parquet").parquet(ledger)
    columns = [f.name for f in LEDGER.fields[1:-1]]
    best = F.max_by(F.struct(*columns), F.struct(final().alias("final"), "run"))
    return rows.groupBy("request_key").agg(best.alias("answer")).select("request_key", "answer.*")


def fetch_with_ledger(requests: DataFrame, ledger: str, **fetch_options) -> DataFrame:
    """``fetch_requests`` through the ledger folder ``ledger``: a response row per request, as there.

    Answered requests are not sent again, by this call or a later one with the
    same ledger.  Bodies live in the ledger's rows, so ``body_mode="file"`` is
    refused.
    """
    if (fetch_options.get("body_mode") or "").lower() == "file":
        raise ValueError("the ledger keeps bodies itself: body_mode must be string, bytes or none")
    if fetch_options.get("on_error", "row") != "row":
        raise ValueError("the ledger keeps failures as rows: on_error must be 'row'")
    keep = tuple(fetch_options.pop("keep", ()))
    spark = requests.sparkSession
    folder = session.qualify(spark, ledger)
    session.mkdirs(spark, folder)
    # requests are read twice, so they are written once
    keyed = objects.materialise(requests.withColumn("request_key", request_key(requests)),
                                f"{session.new_staging_dir(spark, 'ledger-requests')}/requests")
    held = answers(spark, folder)
    run = (spark.read.schema(LEDGER).option("pathGlobFilter", "*.parquet").parquet(folder).agg(F.max("run")).first()[0] or 0) + 1
    todo = (keyed.dropDuplicates(["request_key"]).join(held.where(final()).select("request_key"), "request_key", "left_anti")
            .drop("request_id").withColumnRenamed("request_key", "request_id"))
    (fetch_requests(todo, log=_append(folder, run), **fetch_options).select("request_id")
     .write.format("noop").mode("overwrite").save())
    return (keyed.select("request_key", "request_id", *keep).join(answers(spark, folder), "request_key")
            .select("request_id", *keep, *[f.name for f in LEDGER.fields[1:-1]]))
