"""File sinks: write a DataFrame in one of the connector's file types.

The default write is parallel (one part file per task) straight into the
target URI, honouring the save mode.  ``single_file=True`` delivers exactly
one file at the target path, as the connector's upload contract requires.  Types
made of lines (csv, json, txt; plain, gzip or bzip2) and plain xml are encoded by
all tasks, and their parts joined byte by byte in the order of the partitions,
the csv header and the xml declaration and root once.  Parquet, avro and
compressed xml frame a file as a whole: one writer task.

All writers share one contract for save modes.  Where a write replaces
something itself (single files, staged and encrypted deliveries), the new data
is complete before the old data goes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from .. import session
from ..sources import formats
from . import objects

#: file types and codecs whose files, one after the other, are a file
JOINED_TYPES = ("csv", "json", "txt")
JOINED_CODECS = ("none", "uncompressed", "gzip", "bzip2")
PLAIN_CODECS = ("none", "uncompressed")

SAVE_MODES = ("error", "errorifexists", "append", "overwrite", "ignore")


def check_mode(spark, target: str, mode: str | None, single_file: bool = False) -> str:
    """The normalised save mode of a write to ``target``; raises where the target forbids it."""
    mode = (mode or "errorifexists").lower()
    if mode not in SAVE_MODES:
        raise ValueError(f"unknown save mode {mode!r}; use one of {SAVE_MODES}")
    if session.exists(spark, target):
        if mode in ("error", "errorifexists"):
            raise FileExistsError(f"path {target} already exists")
        if mode == "append" and single_file:
            raise ValueError("append is not possible for a single-file write; "
                             "write in parallel or choose another target")
    return mode


def _columns(partition_by) -> list[str]:
    return [partition_by] if isinstance(partition_by, str) else list(partition_by or ())


def write_files(df: DataFrame, path: str, file_type: str, mode: str = "errorifexists",
                single_file: bool = False, partition_by=None, keep_order: bool = False,
                **options) -> DataFrame:
    """Write ``df`` to ``path``; returns a lazy manifest ``(path, modificationTime, length)``.

    ``mode`` is one of error/errorifexists, append, overwrite, ignore.
    Options as the connector names them: ``header`` (default true),
    ``delimiter`` (default ","), ``codec``/``compression`` for csv,
    ``rowTag``/``rootTag`` for xml; any other Spark writer option passes through.
    ``keep_order`` makes a single file from ``df``'s partitions in their order.
    Files joined of parts always keep it; of the other types it ``coalesce``s
    instead of taking a shuffle that keeps the work above it parallel.
    """
    if not path:
        raise ValueError(formats.MSG_NO_PATH)
    ft = formats.file_type(file_type)
    opts = formats.write_options(ft, formats.normalise(options))
    spark = df.sparkSession
    if single_file:
        if partition_by:
            raise ValueError("a single file has no partition folders; drop partitionBy or singleFile")
        return _write_single(df, path, ft, mode, opts, keep_order)
    mode = (mode or "errorifexists").lower()
    if mode not in SAVE_MODES:
        raise ValueError(f"unknown save mode {mode!r}; use one of {SAVE_MODES}")
    writer = df.write.mode(mode).options(**opts)
    if partition_by:
        writer = writer.partitionBy(*_columns(partition_by))
    formats.save_with(writer, ft, path)
    return objects.LazyListing(spark, path)


def _write_single(df, path, ft, mode, opts, keep_order) -> DataFrame:
    spark = df.sparkSession
    mode = check_mode(spark, path, mode, single_file=True)
    if mode == "ignore" and session.exists(spark, path):
        return objects.LazyListing(spark, path)
    parent, name = path.rstrip("/").rsplit("/", 1)
    tmp = f"{parent}/.{name}-{uuid.uuid4().hex}"
    # one file means no per-file row cap
    opts = {k: v for k, v in opts.items() if k.lower() != "maxrecordsperfile"}
    opts["maxRecordsPerFile"] = "0"
    try:
        if _joinable(ft, opts) and objects.streamable([session.qualify(spark, tmp)]):
            one = _encode_and_join(df, tmp, ft, opts)
        else:
            one = _encode_in_one_task(df.coalesce(1) if keep_order else df.repartition(1), f"{tmp}/parts", ft, opts)
        session.swap(spark, one, path)
    finally:
        session.delete(spark, tmp)
    return objects.LazyListing(spark, path)


def _joinable(ft: str, opts: dict) -> bool:
    """Whether files of this type and these options can be joined byte by byte."""
    codec = (formats.get(opts, "compression") or formats.get(opts, "codec") or "none").lower()
    encoding = (formats.get(opts, "encoding") or formats.get(opts, "charset") or "utf-8").lower()
    joined = codec in PLAIN_CODECS if ft == "xml" else ft in JOINED_TYPES and codec in JOINED_CODECS
    return joined and encoding in ("utf-8", "utf8")


def _encode_and_join(df: DataFrame, tmp: str, ft: str, opts: dict) -> str:
    spark = df.sparkSession
    folders = [f"{tmp}/parts"]
    header = ft == "csv" and formats.flag(opts, "header")
    if header:  # Spark writes it alone when there are no rows
        none = spark.createDataFrame([], df.schema).coalesce(1)
        formats.save_with(none.write.options(**opts), ft, f"{tmp}/header")
        folders.insert(0, f"{tmp}/header")
        opts = {**{k: v for k, v in opts.items() if k.lower() != "header"}, "header": "false"}
    formats.save_with(df.write.options(**opts), ft, f"{tmp}/parts")
    frames = None
    if ft == "xml" and not objects.listing(spark, f"{tmp}/parts").where("length > 0").isEmpty():
        begin, end = _xml_frame(spark, f"{tmp}/frame", opts)
        objects.write_bytes(session.qualify(spark, f"{tmp}/begin/part-0"), begin)
        objects.write_bytes(session.qualify(spark, f"{tmp}/end/part-0"), end)
        folders, frames = [f"{tmp}/begin", f"{tmp}/parts", f"{tmp}/end"], {1: (len(begin), len(end))}
    if not objects.join_files(spark, folders, f"{tmp}/one", frames=frames, consume=True):  # no bytes at all: an empty part is the file
        return session.data_files(spark, folders[-1])[0]
    return f"{tmp}/one"


def _xml_frame(spark, folder: str, opts: dict) -> tuple[bytes, bytes]:
    """What Spark's xml writer puts before and after the rows of a file, as it frames one row without a value."""
    plain = {k: v for k, v in opts.items() if k.lower() != "nullvalue"}
    formats.save_with(spark.range(1).select(F.lit(None).cast("int").alias("none")).coalesce(1).write.options(**plain), "xml", folder)
    fs, where = objects.arrow_location(session.data_files(spark, folder)[0])
    with fs.open_input_stream(where) as src:
        one = src.read()
    row = f"<{formats.get(opts, 'rowTag')}/>".encode()
    at = one.rindex(row)
    # the line feed and indent before a row are part of the row
    feed = one.rfind(b"\n", 0, at)
    return one[:at if feed < 0 else feed], one[at + len(row):]


def _encode_in_one_task(one: DataFrame, folder: str, ft: str, opts: dict) -> str:
    spark = one.sparkSession
    formats.save_with(one.write.mode("overwrite").options(**opts), ft, folder)
    parts = session.data_files(spark, folder)
    if ft == "parquet":
        parts = [p for p in parts if p.endswith(".parquet")]
    if len(parts) != 1:
        raise RuntimeError(f"expected one part file under {folder}, found {len(parts)}")
    return parts[0]


def deliver(df: DataFrame, target: str, file_type: str, mode: str = "errorifexists",
            single_file: bool = False, staging_dir: str | None = None, partition_by=None,
            **options) -> DataFrame:
    """Write into staging first, then copy the finished files to ``target``.

    For targets without a cheap atomic rename (object stores, SFTP): Spark's
    commit protocol runs on the staging filesystem, and the target only ever
    receives complete files, copied by executor tasks.  An overwrite copies
    beside the target and then swaps.  Returns the materialised copy manifest
    ``(uri, staged_path, length, modification_time, error)`` where
    ``staged_path`` is the delivered file.
    """
    spark = df.sparkSession
    mode = check_mode(spark, target, mode, single_file)
    there = session.exists(spark, target)
    if there and mode == "ignore":
        return objects.LazyListing(spark, target)
    work = staging_dir or session.new_staging_dir(spark, "deliver")
    target = target.rstrip("/")
    parent, name = target.rsplit("/", 1)
    staged = f"{work}/out/{name}"
    write_files(df, staged, file_type, mode="overwrite", single_file=single_file, partition_by=partition_by, **options)
    files = objects.listing(spark, staged)
    incoming = f"{parent}/.{name}-{uuid.uuid4().hex}.incoming" if there and mode == "overwrite" else None
    dest = incoming or (parent if single_file else target)
    manifest = objects.materialise(objects.copy_files(files, [f"{work}/out" if single_file else staged], dest),
                                   f"{work}/_manifest")
    bad = objects.failed(manifest).count()
    if bad:
        if incoming:
            session.delete(spark, incoming)
        raise RuntimeError(f"{bad} files failed to deliver to {target}; staged copy kept at {staged}")
    if incoming:
        session.swap(spark, f"{incoming}/{name}" if single_file else incoming, target)
        session.delete(spark, incoming)
        old = session.qualify(spark, incoming) + (f"/{name}" if single_file else "")
        final = F.concat(F.lit(session.qualify(spark, target)), F.expr(f"substr(staged_path, {len(old) + 1})"))
        manifest = manifest.withColumn("staged_path", final)
    return manifest


class Writer:
    """Option-builder mirroring ``df.write.format(..).option(..).mode(..).save(path)``.

    ``singleFile=true`` delivers one file, as the connector does;
    ``stage=true`` or a ``tempLocation``/``hdfsTempLocation``/``stagingLocation``
    writes there first and then copies the files to the target (``deliver``).
    To an http or https URL json rows are posted in batches (``post_rows``):
    ``batchRows``, ``batchBytes``, ``postFolder`` and the fetch options apply,
    and the mode must be ``append``.
    """

    def __init__(self, df: DataFrame):
        self._df = df
        self._options: dict[str, str] = {}
        self._mode = "errorifexists"
        self.manifest: DataFrame | None = None

    def format(self, file_type: str) -> "Writer":
        """Same as ``option("fileType", file_type)``."""
        return self.option("fileType", file_type)

    def option(self, key: str, value) -> "Writer":
        self._options[key] = value
        return self

    def options(self, **opts) -> "Writer":
        self._options.update(opts)
        return self

    def mode(self, mode: str) -> "Writer":
        self._mode = mode
        return self

    def save(self, path=None) -> DataFrame:
        from ..sources.remote import resolve
        from ..sources.rest import is_endpoint

        opts = formats.normalise(self._options)
        if is_endpoint(path or formats.get(opts, "path")):
            return self._post(path or formats.get(opts, "path"), opts)
        path = resolve(self._df.sparkSession, path or formats.get(opts, "path"), opts)
        ft = formats.get(opts, "fileType")
        single = formats.flag(opts, "singleFile")
        parts = formats.get(opts, "partitionBy")
        partition_by = [c.strip() for c in parts.split(",") if c.strip()] if parts else None
        rest = {k: v for k, v in opts.items()
                if k.lower() not in ("path", "filetype", "singlefile", "partitionby")}
        staging = formats.get(opts, "stagingLocation")
        key, key_file = formats.get(opts, "cryptoKey"), formats.get(opts, "cryptoKeyFile")
        if key is not None or key_file is not None:
            from .crypto import write_encrypted

            self.manifest = write_encrypted(
                self._df, path, ft, key_file, key_id=formats.get(opts, "cryptoKeyId", "default"),
                algorithm=formats.get(opts, "cryptoAlgorithm"), key=key, single_file=single,
                mode=self._mode, partition_by=partition_by, **rest)
        elif formats.flag(opts, "stage") or staging is not None:
            work = session.new_staging_dir(self._df.sparkSession, "deliver", root=staging)
            self.manifest = deliver(self._df, path, ft, self._mode, single_file=single,
                                    staging_dir=work, partition_by=partition_by, **rest)
        else:
            self.manifest = write_files(self._df, path, ft, self._mode, single_file=single,
                                        partition_by=partition_by, **rest)
        return self.manifest

    def _post(self, url: str, opts: dict) -> DataFrame:
        import json

        from ..sources.rest import fetch_options
        from .post import BATCH_BYTES, BATCH_ROWS, post_rows

        if self._mode.lower() != "append":
            raise ValueError("rows are added to an endpoint: use mode 'append'")
        if formats.file_type(formats.get(opts, "fileType", "json")) != "json":
            raise ValueError("endpoints take json rows")
        headers = formats.get(opts, "headers")
        how = {k: v for k, v in fetch_options(opts).items() if k != "on_error"}
        self.manifest = post_rows(
            self._df, url, formats.get(opts, "postFolder"), batch_rows=int(formats.get(opts, "batchRows", BATCH_ROWS)),
            batch_bytes=int(formats.get(opts, "batchBytes", BATCH_BYTES)),
            headers=json.loads(headers) if isinstance(headers, str) else headers, **how)
        return self.manifest
