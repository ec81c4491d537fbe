"""File-level encryption for deliveries and encrypted drops.

Whole files are encrypted or decrypted with Spark's ``aes_encrypt`` /
``aes_decrypt`` on the executors.  The key is never a literal in the plan: it
is read from a key file into a small ``(key_id, key)`` table, and the chosen
key enters the expression as a scalar subquery -- evaluated once, exactly one
value (a duplicated key id is an error), and shown in plans only as
``Subquery``, never by value.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import session
from ..sources import formats
from ..sources.files import read_files
from . import objects
from .sink import write_files

# JCE-style transformation names and their Spark AES mode/padding.
# A bare "AES" is the JCE default transformation, AES/ECB/PKCS5Padding.
TRANSFORMATIONS = {
    "AES": ("ECB", "PKCS"),
    "AES/ECB/PKCS5PADDING": ("ECB", "PKCS"),
    "AES/CBC/PKCS5PADDING": ("CBC", "PKCS"),
    "AES/GCM/NOPADDING": ("GCM", "NONE"),
}


def mode_of(algorithm: str | None) -> tuple[str, str]:
    key = (algorithm or formats.CONNECTOR_DEFAULTS["cryptoAlgorithm"]).upper()
    if key not in TRANSFORMATIONS:
        raise ValueError(f"cryptoAlgorithm {algorithm} not supported; use one of {list(TRANSFORMATIONS)}")
    return TRANSFORMATIONS[key]


def key_table(spark: SparkSession, key_file: str) -> DataFrame:
    """``(key_id, key)`` from a key file: lines ``id=key``, or one bare key (id ``default``)."""
    lines = spark.read.text(key_file).filter(F.trim("value") != "")
    has_id = F.col("value").contains("=")
    return lines.select(
        F.when(has_id, F.trim(F.substring_index("value", "=", 1))).otherwise(F.lit("default")).alias("key_id"),
        F.when(has_id, F.trim(F.expr("substr(value, instr(value, '=') + 1)")))
         .otherwise(F.trim("value")).cast("binary").alias("key"),
    )


def key_column(spark: SparkSession, key_file: str | None = None, key_id: str = "default",
               key: str | None = None):
    """The AES key as a scalar-subquery column (never a literal in the plan).

    From ``key_file`` (selected by ``key_id``) or, as the connector's
    ``cryptoKey`` option does, from the key text itself.
    """
    if key is not None:
        frame = spark.createDataFrame([(key,)], "key string").select(F.col("key").cast("binary"))
    elif key_file is not None:
        frame = key_table(spark, key_file).filter(F.col("key_id") == key_id).select("key")
    else:
        raise ValueError("an AES key is needed: cryptoKeyFile or cryptoKey")
    return frame.scalar()


def _transform(spark, src_uri, dest_dir, key_file, key_id, algorithm, encrypt: bool,
               suffix_from: str = "", suffix_to: str = "", key: str | None = None) -> DataFrame:
    mode, padding = mode_of(algorithm)
    src = session.qualify(spark, src_uri).rstrip("/")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(src)
             .select("path", "content"))
    key = key_column(spark, key_file, key_id, key)
    fn = F.aes_encrypt if encrypt else F.aes_decrypt
    # path relative to the source folder; a single-file source keeps its name
    rel = F.when(F.col("path") == src, F.regexp_extract("path", r"([^/]+)$", 1)) \
           .otherwise(F.expr("substr(path, {})".format(len(src) + 2)))
    if suffix_from:
        rel = F.regexp_replace(rel, re.escape(suffix_from) + "$", "")
    out = files.select(
        F.concat(rel, F.lit(suffix_to)).alias("name"),
        fn(F.col("content"), key, F.lit(mode), F.lit(padding)).alias("payload"))
    # binaryFile already spreads files over tasks: no shuffle of the payloads
    manifest = objects.write_objects(out, "name", "payload", dest_dir, keys_are_paths=True)
    return objects.materialise(manifest, f"{session.new_staging_dir(spark, 'crypto')}/_manifest")


def encrypt_files(spark, src_uri, dest_dir, key_file=None, key_id="default", algorithm=None,
                  key=None) -> DataFrame:
    """Encrypt every file under ``src_uri`` into ``dest_dir/<name>.enc``; returns the manifest.

    A file is one value while it is encrypted, so files of up to 2 GB.
    """
    return _transform(spark, src_uri, dest_dir, key_file, key_id, algorithm, True, "", ".enc", key)


def decrypt_files(spark, src_uri, dest_dir, key_file=None, key_id="default", algorithm=None,
                  key=None) -> DataFrame:
    """Decrypt every file under ``src_uri`` into ``dest_dir`` (drops ``.enc``); returns the manifest."""
    return _transform(spark, src_uri, dest_dir, key_file, key_id, algorithm, False, ".enc", "", key)


#: the column of encrypted rows
PAYLOAD = "payload"

#: rows of a part file that is encrypted whole, so parts stay far below the 2 GB of one value
ROWS_PER_ENCRYPTED_FILE = 200_000


def write_encrypted(df: DataFrame, path: str, file_type: str, key_file: str | None = None,
                    key_id: str = "default", algorithm: str | None = None,
                    key: str | None = None, single_file: bool = False, mode: str = "errorifexists",
                    partition_by=None, **options) -> DataFrame:
    """Deliver ``df`` as encrypted files, as other parties read them.

    Written in parallel to staging, then encrypted file by file: with
    ``single_file`` the one encrypted file is ``path`` itself; otherwise
    ``path`` is a folder of ``<part>.enc`` files of at most
    ``ROWS_PER_ENCRYPTED_FILE`` rows each.  The plaintext staging folder is
    removed whether or not the delivery succeeds.  For deliveries that only
    this library reads back, ``write_encrypted_rows`` stages no plaintext.
    """
    from .sink import check_mode

    spark = df.sparkSession
    mode = check_mode(spark, path, mode, single_file)
    there = session.exists(spark, path)
    if there and mode == "ignore":
        return objects.LazyListing(spark, path)
    work = session.new_staging_dir(spark, "plain")
    parent, name = path.rstrip("/").rsplit("/", 1)
    incoming = f"{parent}/.{name}-{uuid.uuid4().hex}.incoming" if there and mode == "overwrite" else None
    try:
        if single_file:
            write_files(df, f"{work}/data/{name}", file_type, single_file=True, **options)
            manifest = _transform(spark, f"{work}/data", incoming or parent, key_file, key_id, algorithm, True, key=key)
        else:
            if formats.get(options, "maxRecordsPerFile") is None:
                options["maxRecordsPerFile"] = ROWS_PER_ENCRYPTED_FILE
            write_files(df, f"{work}/data", file_type, mode="overwrite", partition_by=partition_by, **options)
            manifest = encrypt_files(spark, f"{work}/data", incoming or path, key_file, key_id, algorithm, key)
        bad = objects.failed(manifest).count()
        if bad:
            raise RuntimeError(f"{bad} files failed to encrypt for {path}; nothing was replaced")
        if incoming:
            session.swap(spark, f"{incoming}/{name}" if single_file else incoming, path)
            session.delete(spark, incoming)
    except Exception:
        if incoming:
            session.delete(spark, incoming)
        raise
    finally:
        session.delete(spark, work)
    return manifest


class Decrypted:
    """A scan of decrypted copies; ``clear`` (or leaving a ``with``) removes the plaintext."""

    def __init__(self, spark: SparkSession, frame: DataFrame, folder: str):
        self.frame, self._spark, self.folder = frame, spark, folder

    def clear(self) -> None:
        session.delete(self._spark, self.folder)

    def __enter__(self) -> DataFrame:
        return self.frame

    def __exit__(self, *_):
        self.clear()


def decrypted(spark: SparkSession, path: str, file_type: str, key_file: str | None = None,
              schema=None, key_id: str = "default", algorithm: str | None = None,
              key: str | None = None, **options) -> Decrypted:
    """Decrypt an encrypted drop into staging and scan it natively, with a handle to remove the copies."""
    work = session.new_staging_dir(spark, "decrypted")
    manifest = decrypt_files(spark, path, f"{work}/data", key_file, key_id, algorithm, key)
    bad = objects.failed(manifest).count()
    if bad:
        session.delete(spark, work)
        raise RuntimeError(f"{bad} files failed to decrypt under {path}")
    return Decrypted(spark, read_files(spark, f"{work}/data", file_type, schema, **options), work)


def read_encrypted(spark: SparkSession, path: str, file_type: str, key_file: str | None = None,
                   schema=None, key_id: str = "default", algorithm: str | None = None,
                   key: str | None = None, **options) -> DataFrame:
    """The frame of ``decrypted``; its plaintext copies stay in staging while the frame is read."""
    return decrypted(spark, path, file_type, key_file, schema, key_id, algorithm, key, **options).frame


def write_encrypted_rows(df: DataFrame, path: str, key_file: str | None = None, key_id: str = "default",
                         algorithm: str | None = None, key: str | None = None,
                         mode: str = "errorifexists", partition_by=None) -> None:
    """Deliver ``df`` as a table of encrypted rows, encrypted in the JVM; no plaintext is staged.

    Rows are serialised as JSON, encrypted and written by the parallel,
    splittable Parquet writer as one binary column.  Partition columns stay
    readable in the folder names, where Spark has null for an empty string.
    """
    from .sink import _columns, check_mode

    cipher, padding = mode_of(algorithm)
    spark = df.sparkSession
    mode = check_mode(spark, path, mode)
    if session.exists(spark, path) and mode == "ignore":
        return
    parts = _columns(partition_by)
    if PAYLOAD in parts:
        raise ValueError(f"{PAYLOAD!r} names the encrypted rows; it cannot be a partition column")
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in parts]),
                    {"ignoreNullFields": "false", "timestampNTZFormat": formats.TS_NTZ_FORMAT,
                     "timestampFormat": formats.TS_LTZ_FORMAT})
    payload = F.aes_encrypt(row.cast("binary"), key_column(spark, key_file, key_id, key), F.lit(cipher), F.lit(padding))
    out = df.select(*[F.col(f"`{c}`") for c in parts], payload.alias(PAYLOAD))
    replace = mode == "overwrite" and session.exists(spark, path)
    parent, name = path.rstrip("/").rsplit("/", 1)
    target = f"{parent}/.{name}-{uuid.uuid4().hex}.incoming" if replace else path
    writer = out.write.mode("append")
    (writer.partitionBy(*parts) if parts else writer).parquet(target)
    if replace:
        session.swap(spark, target, path)


def read_encrypted_rows(spark: SparkSession, path: str, schema, key_file: str | None = None,
                        key_id: str = "default", algorithm: str | None = None, key: str | None = None) -> DataFrame:
    """Read ``write_encrypted_rows`` back: a native scan, decrypted row by row in the JVM.

    ``schema`` is that of the rows and gives partition columns their type too;
    one that it does not name comes last, with the type its folders suggest.
    """
    cipher, padding = mode_of(algorithm)
    declared = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    found = [f for f in spark.read.parquet(path).schema.fields if f.name != PAYLOAD]
    by_name = {f.name: f for f in declared.fields}
    parts = [T.StructField(f.name, by_name.get(f.name, f).dataType) for f in found]
    stored = spark.read.schema(T.StructType([T.StructField(PAYLOAD, T.BinaryType()), *parts])).parquet(path)
    plain = F.aes_decrypt(PAYLOAD, key_column(spark, key_file, key_id, key), F.lit(cipher), F.lit(padding))
    in_folders = {f.name for f in parts}
    inside = T.StructType([f for f in declared.fields if f.name not in in_folders])
    rows = stored.select(F.from_json(plain.cast("string"), inside).alias("r"), *[F.col(f"`{f.name}`") for f in parts])
    order = [F.col(f"`{f.name}`") if f.name in in_folders else F.col(f"r.`{f.name}`") for f in declared.fields]
    return rows.select(*order, *[F.col(f"`{f.name}`") for f in parts if f.name not in by_name])
