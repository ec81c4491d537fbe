"""Helpers the corpus operators share: word patterns, staging, bounded broadcasts, worker state."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lading import session
from lading.plans.tables import table  # noqa: F401  (re-exported for the operators)

#: a word: a run of anything but ASCII white space (same pattern in Java, RE2 and Python)
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: a side is broadcast only when it was counted and has at most this many narrow rows
BROADCAST_ROWS = 500_000

#: bytes of an Arrow batch on its way to Python, where Spark's default holds
BATCH_CONF, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8388608b"


def spark_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


#: rows of megabytes: Parquet else holds 100 of them before it looks at their size, and readers a row group
WIDE_ROWS = {"parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "10"}


def staged(df: DataFrame, label: str, codec: str = "snappy", **options) -> DataFrame:
    """Write ``df`` to the shared staging folder and read it back.

    Cuts the lineage, so a lost executor costs a re-read instead of a
    recomputation, and gives later plans true sizes.  ``session.delete`` on the
    folder, or ``clear_staged``, removes it when the results are no longer read.
    ``options`` are the Parquet writer's, ``WIDE_ROWS`` for rows of megabytes.
    """
    spark = spark_of(df)
    path = session.new_staging_dir(spark, f"llm-{label}")
    df.write.options(**options).parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> None:
    """Remove everything ``staged`` wrote under this session's staging folder."""
    root = f"{session.staging_root(spark)}/lading"
    if session.exists(spark, root):
        for folder in session.subdirs(spark, root):
            if folder.rsplit("/", 1)[-1].startswith("llm-"):
                session.delete(spark, folder)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else ``df`` as it is.

    Call it on staged or otherwise cheap frames: it counts them.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def packed(docs: DataFrame, *needed: str) -> DataFrame:
    """``docs`` as one struct column ``_row`` beside the ``needed`` columns.

    Operators that pass all columns through join on this and unpack ``_row.*``
    at the end, so no column of the caller can clash with one of theirs.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *needed)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` alone also folds other letters)."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def n_words(text: Column) -> Column:
    """Number of words; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def mapped(df: DataFrame, run, schema: str, keep: str | None = None) -> DataFrame:
    """``df.mapInArrow(run, schema)`` in bounded memory.

    Arrow batches are bounded by bytes (unless the session says otherwise), not
    only by rows.  Workers outlive a stage, so a task first drops what other
    operators keep there (all but the states whose names begin with ``keep``)
    and gives its free memory back when its partition ends.
    """
    conf = spark_of(df).conf
    if conf.get(BATCH_CONF) == BATCH_DEFAULT:
        conf.set(BATCH_CONF, BATCH_BYTES)

    def task(batches):
        _drop_states(keep)
        try:
            yield from run(batches)
        finally:
            _give_back()

    return df.mapInArrow(task, schema)


def cogrouped(left: DataFrame, left_key: str, right: DataFrame, right_key: str, run, schema: str) -> DataFrame:
    """``run(left rows, right rows)`` of each key, as Arrow tables; workers drop what operators keep there, as in ``mapped``."""
    def task(one, other):
        _drop_states(None)
        try:
            return run(one, other)
        finally:
            _give_back()

    return left.groupBy(left_key).cogroup(right.groupBy(right_key)).applyInArrow(task, schema)


def _drop_states(keep: str | None) -> None:
    held = _worker_module().__dict__
    for name in [n for n in held if not n.startswith("__") and not (keep and n.startswith(keep))]:
        del held[name]


def _give_back() -> None:
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim:
        trim(0)


def _worker_module() -> types.ModuleType:
    return sys.modules.setdefault("_lading_worker_state", types.ModuleType("_lading_worker_state"))


def worker_state(name: str, make):
    """An object kept per Python worker process and reused by its later tasks.

    Task code is shipped by value, so module globals start anew with each task;
    this keeps caches (never results) in a private module instead.
    """
    held = _worker_module().__dict__
    if name not in held:
        held[name] = make()
    return held[name]
