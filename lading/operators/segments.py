"""Segmented authenticated encryption of files of any size.

A file becomes segments of a fixed size, rows of a Parquet table: each is
encrypted by itself with AES-GCM, under its own random nonce, with the file, the
segment's number and the file's number of segments as associated data.  So
segments are encrypted and decrypted by any number of tasks, none is ever larger
than a segment, and a segment that was altered, renumbered or moved to another
file fails to decrypt.  Missing, repeated or surplus segments are found from the
small columns before anything is decrypted.  Spark's commit protocol writes the
table; no plaintext is staged on either side.

With ``lines`` a segment ends where a line does (a line belongs to the segment
that it begins in), so csv, json and text files are parsed segment by segment
in the JVM: ``read_encrypted_segments``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import session
from ..sources import formats
from . import objects
from .crypto import key_column

SEGMENT_BYTES = 8 << 20
#: segments that one task encrypts, about
SEGMENTS_A_TASK = 16
SCHEMA = "name string, file_id string, number long, segments long, payload binary"


def _aad() -> Column:
    return F.concat_ws("\n", "file_id", "name", F.col("number").cast("string"), F.col("segments").cast("string"))


def _line_start(source, at: int, size: int) -> int:
    """The first line start at or after ``at``."""
    if at <= 0 or at >= size:
        return max(0, min(at, size))
    source.seek(at - 1)
    done = at - 1
    while chunk := source.read(1 << 16):
        found = chunk.find(b"\n")
        if found >= 0:
            return done + found + 1
        done += len(chunk)
    return size


def _read_segments(segment_bytes: int, lines: bool):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for k, (path, number, size) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("path", "number", "length")))):
                fs, where = objects.arrow_location(path)
                begin, end = number * segment_bytes, min((number + 1) * segment_bytes, size)
                with fs.open_input_file(where) as source:
                    if source.size() != size:
                        raise OSError(f"{path} changed while it was read")
                    if lines:
                        begin, end = _line_start(source, begin, size), _line_start(source, end, size)
                    source.seek(begin)
                    content = source.read(end - begin)
                if len(content) != end - begin:
                    raise OSError(f"{path} ended early")
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(k, 1) for c in ("name", "file_id", "number", "segments")),
                     pa.array([content], pa.binary())], names=["name", "file_id", "number", "segments", "content"])

    return run


def encrypt_segments(spark: SparkSession, src_uri: str, dest: str, key_file: str | None = None, key_id: str = "default",
                     key: str | None = None, segment_bytes: int = SEGMENT_BYTES, lines: bool = False,
                     mode: str = "errorifexists") -> DataFrame:
    """Encrypt every file under ``src_uri`` into the segment table ``dest``; returns its ``name, file_id, segments``.

    The source must be one that tasks can open (``objects.streamable``).  An
    empty file, which Spark's listing leaves out, has no segment.
    """
    if segment_bytes < 1:
        raise ValueError("segment_bytes must be positive")
    src = session.qualify(spark, src_uri).rstrip("/")
    if not objects.streamable([src]):
        raise ValueError(f"tasks cannot open {src}; stage it first")
    listed = objects.listing(spark, src)
    rel = F.when(F.col("path") == src, F.regexp_extract("path", r"([^/]+)$", 1)).otherwise(F.expr(f"substr(path, {len(src) + 2})"))
    segments = F.greatest(F.ceil(F.col("length") / segment_bytes), F.lit(1))
    files = listed.select("path", "length", rel.alias("name"), F.sha1(F.concat(F.lit(uuid.uuid4().hex), "path")).alias("file_id"),
                          segments.cast("long").alias("segments"))
    total = files.agg(F.sum("segments")).first()[0] or 0
    parts = max(1, min(-(-total // SEGMENTS_A_TASK), 100_000), min(total, spark.sparkContext.defaultParallelism))
    ranges = files.withColumn("number", F.explode(F.sequence(F.lit(0).cast("long"), F.col("segments") - 1))).repartition(parts)
    plain = ranges.mapInArrow(_read_segments(segment_bytes, lines),
                              "name string, file_id string, number long, segments long, content binary")
    sealed = F.aes_encrypt("content", key_column(spark, key_file, key_id, key), F.lit("GCM"), F.lit("DEFAULT"),
                           F.lit("").cast("binary"), _aad().cast("binary"))
    plain.select("name", "file_id", "number", "segments", sealed.alias("payload")).write.mode(mode).parquet(dest)
    return spark.read.schema(SCHEMA).parquet(dest).where("number = 0").select("name", "file_id", "segments")


def decrypt_segments(spark: SparkSession, path: str, key_file: str | None = None, key_id: str = "default",
                     key: str | None = None) -> DataFrame:
    """``name, file_id, number, content`` of every segment, decrypted in the JVM where it is read.

    Raises at once if a file's segments are not exactly its own; a segment whose
    bytes, number or file is not what was written fails when it is read.
    """
    rows = spark.read.schema(SCHEMA).parquet(path)
    each = rows.groupBy("file_id").agg(F.min("name").alias("name"), F.count(F.lit(1)).alias("n"),
                                       F.count_distinct("number").alias("numbers"), F.min("number").alias("lo"),
                                       F.max("number").alias("hi"), F.min("segments").alias("least"), F.max("segments").alias("most"))
    bad = each.where("NOT (n = numbers AND n = least AND n = most AND lo = 0 AND hi = n - 1)").select("name", "n", "most").first()
    if bad is not None:
        raise ValueError(f"{bad.name}: {bad.n} segments where {bad.most} were written; the file is not whole")
    content = F.aes_decrypt("payload", key_column(spark, key_file, key_id, key), F.lit("GCM"), F.lit("DEFAULT"), _aad().cast("binary"))
    return rows.select("name", "file_id", "number", content.alias("content"))


def read_encrypted_segments(spark: SparkSession, path: str, file_type: str, schema, key_file: str | None = None,
                            key_id: str = "default", key: str | None = None, **options) -> DataFrame:
    """The rows of encrypted csv, json or text files written with ``lines``; nothing is staged.

    Records are lines: multi-line csv or json is refused.  Blank lines are no
    records of csv and json.
    """
    ft = formats.file_type(file_type)
    given = formats.normalise(options)
    opts = formats.read_options(ft, given)
    if ft not in ("csv", "json", "txt") or formats.flag(opts, "multiLine"):
        raise ValueError("segments are parsed line by line: csv, json or txt without multiLine")
    header = ft == "csv" and formats.flag(opts, "header")
    text = F.regexp_replace(F.decode("content", "UTF-8"), r"\r?\n\z", "")
    parts = F.when(F.length(F.decode("content", "UTF-8")) == 0, F.array().cast("array<string>")).otherwise(F.split(text, r"\r?\n", -1))
    lines = decrypt_segments(spark, path, key_file, key_id, key).select("number", F.posexplode(parts).alias("at", "value"))
    if header:
        lines = lines.where("number > 0 OR at > 0")
    if ft == "txt":
        return lines.select("value")
    lines = lines.where("trim(value) <> ''")
    fields = schema if isinstance(schema, str) else schema.simpleString()
    wanted = {k: v for k, v in opts.items() if k.lower() not in ("header", "inferschema")}
    parsed = F.from_csv("value", ddl_of(spark, fields), wanted) if ft == "csv" else F.from_json("value", schema, wanted)
    return lines.select(parsed.alias("r")).select("r.*")


def ddl_of(spark: SparkSession, schema) -> str:
    """A schema as DDL text, which ``from_csv`` takes."""
    if not isinstance(schema, T.StructType):
        schema = T._parse_datatype_string(schema)
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
