"""File sources: native scans by file type, newest-drop selection, staging.

``read_files`` returns an ordinary native ``FileScan`` plan, so Catalyst prunes
columns and pushes filters into it.  ``latest_file`` and ``stage_files`` work
from a metadata-only listing (no file content is read for it), and copying is
spread over executor tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import session
from ..operators import objects
from . import formats


def read_files(spark: SparkSession, path, file_type: str, schema=None, **options) -> DataFrame:
    """Read files of one type into a DataFrame.

    ``schema`` (``StructType`` or DDL string) is applied when given; otherwise
    csv honours ``inferSchema`` (default ``false``: every column a string),
    json and xml infer, parquet and avro are self-describing.
    """
    ft = formats.file_type(file_type)
    opts = formats.read_options(ft, formats.normalise(options))
    reader = spark.read.options(**opts)
    if schema is not None:
        reader = reader.schema(schema)
    if path is None or (not isinstance(path, str) and len(list(path)) == 0):
        raise ValueError(formats.MSG_NO_PATH)
    return formats.load_with(reader, ft, path if isinstance(path, str) else list(path))


def with_root(spark: SparkSession, listing: DataFrame, roots) -> DataFrame:
    """Tag each listed file with the root (dataset) it was found under."""
    return objects.under_roots(spark, listing, roots).drop("rank", "rel")


def drop_of(path: str = "path", root: str = "root"):
    """The drop a file belongs to: the first folder under its root, or the root for a file right there."""
    first = F.regexp_extract(F.expr(f"substr({path}, length({root}) + 2)"), r"^([^/]+)/", 1)
    return F.when(first == "", F.col(root)).otherwise(F.concat(F.col(root), F.lit("/"), first))


def newest(listing: DataFrame, by: str = "file") -> DataFrame:
    """The newest object of each dataset in a listing, as ``(root, path)`` rows.

    ``by="file"``: the newest file (ties broken by the larger path).
    ``by="directory"``: the drop holding the newest file, whole: everything
    below the first folder under the root.
    Without a ``root`` column the whole listing is one dataset.  Per-dataset
    maxima are partial aggregates combined map-side, so a dataset holding
    most of the files is no hot spot.
    """
    if by not in ("file", "directory"):
        raise ValueError(f"latest by must be 'file' or 'directory', not {by!r}")
    if "root" not in listing.columns:
        listing = listing.withColumn("root", F.lit(None).cast("string"))
    if by == "file":
        return listing.groupBy("root").agg(
            F.max_by("path", F.struct("modificationTime", "path")).alias("path"))
    drop = F.coalesce(drop_of(), _parent(F.col("path")))
    drops = listing.groupBy("root", drop.alias("drop")).agg(F.max("modificationTime").alias("modificationTime"))
    return drops.groupBy("root").agg(
        F.max_by("drop", F.struct("modificationTime", "drop")).alias("path"))


def latest_file(spark: SparkSession, uri, by: str = "file"):
    """URI of the newest file (or drop directory) under ``uri``.

    For a list of roots, one newest URI per root (in the order given).  The
    listing and the maxima run as Spark aggregates; only the chosen paths --
    one per root -- come back to the driver.
    """
    roots = [uri] if isinstance(uri, str) else list(uri)
    picks = {r["root"]: r["path"] for r in
             newest(with_root(spark, objects.listing(spark, roots), roots), by).collect()}
    out = []
    for r in roots:
        path = picks.get(session.qualify(spark, r).rstrip("/"))
        if path is None:
            raise FileNotFoundError(f"no files under {r}")
        out.append(path)
    return out[0] if isinstance(uri, str) else out


def stage_files(spark: SparkSession, uris, staging_dir: str | None = None,
                latest: bool = False, latest_by: str = "file",
                parallelism: int | None = None) -> DataFrame:
    """Copy remote objects into the shared staging folder, in parallel.

    Returns the materialised manifest ``(uri, staged_path, length,
    modification_time, error)``; staged data lives under
    ``<staging_dir>/data`` keeping each object's path relative to its root.
    """
    roots = [uris] if isinstance(uris, str) else list(uris)
    target = staging_dir or session.new_staging_dir(spark, "stage")
    files = objects.listing(spark, roots)
    if latest:
        rooted = with_root(spark, files, roots)
        pick = newest(rooted, latest_by).select(F.col("path").alias("pick"))
        unit = F.col("path") if latest_by == "file" else drop_of()
        # an equi-join with one row per root; AQE picks its strategy
        files = (rooted.withColumn("unit", unit)
                       .join(pick, F.col("unit") == F.col("pick"), "left_semi")
                       .drop("unit", "root"))
    if objects.streamable(roots) and objects.streamable([target]):
        manifest = objects.copy_files(files, roots, f"{target}/data", parallelism)
    else:
        # schemes only Hadoop can read (e.g. sftp): content via binaryFile
        # with copyLatest, scan content of the newest picks only
        sources = latest_file(spark, roots, latest_by) if latest else None
        manifest = objects.copy_files_via_spark(spark, files, roots, f"{target}/data", sources)
    return objects.materialise(manifest, f"{target}/_manifest")


def _parent(path):
    return F.regexp_extract(path, r"^(.*)/[^/]+$", 1)


def load_remote(spark: SparkSession, path, file_type: str, schema=None, **options):
    """The connector's read lifecycle as one call.

    * ``copyLatest=true``: only the newest object under ``path`` is used
      (``latestBy=directory``: the newest drop, whole, i.e. the first folder
      under ``path`` and everything below it).
    * ``stage=true``, ``createDF=false`` or a named staging folder
      (``stagingLocation`` / ``tempLocation`` / ``hdfsTempLocation``): objects
      are copied there before reading; otherwise ``path`` is scanned directly.
    * ``createDF=false``: returns an empty DataFrame with the declared schema
      (empty schema if none) -- the fetch-only contract.
    * ``cryptoKey`` / ``cryptoKeyFile`` (+ ``cryptoKeyId``, ``cryptoAlgorithm``):
      the objects are encrypted; they are decrypted into staging, then scanned.

    Returns ``(DataFrame, manifest or None)``.
    """
    opts = formats.normalise(options)
    ft = formats.file_type(formats.get(opts, "fileType", file_type))
    if path is None:
        raise ValueError(formats.MSG_NO_PATH)
    create_df = formats.flag(opts, "createDF", formats.CONNECTOR_DEFAULTS["createDF"])
    latest = formats.flag(opts, "copyLatest", formats.CONNECTOR_DEFAULTS["copyLatest"])
    latest_by = formats.get(opts, "latestBy", "file")
    # naming a temp/staging location asks for the copy, as the connector's does
    stage = (formats.flag(opts, "stage") or not create_df
             or formats.get(opts, "stagingLocation") is not None)
    manifest = None
    source = path
    if stage:
        where = formats.get(opts, "stagingLocation")
        target = session.new_staging_dir(spark, "stage", root=where)
        manifest = stage_files(spark, path, target, latest=latest, latest_by=latest_by)
        bad = objects.failed(manifest).count()
        if bad:
            # never read a partial copy: the frame must hold every object
            first = objects.failed(manifest).select("uri", "error").first()
            raise RuntimeError(f"{bad} objects failed to stage, e.g. {first.uri}: {first.error}")
        source = f"{target}/data"
    elif latest:
        source = latest_file(spark, path, latest_by)
    if not create_df:
        return spark.createDataFrame([], schema or T.StructType([])), manifest
    key, key_file = formats.get(opts, "cryptoKey"), formats.get(opts, "cryptoKeyFile")
    if key is not None or key_file is not None:
        from ..operators.crypto import read_encrypted

        return read_encrypted(spark, source, ft, key_file, schema,
                              key_id=formats.get(opts, "cryptoKeyId", "default"),
                              algorithm=formats.get(opts, "cryptoAlgorithm"), key=key,
                              **opts), manifest
    return read_files(spark, source, ft, schema, **opts), manifest


class Reader:
    """Option-builder mirroring ``spark.read.format(..).option(..).load(path)``.

    >>> df = Reader(spark).option("fileType", "csv").option("delimiter", ";").load(uri)

    http and https URLs are endpoints: their bodies are fetched and scanned (``read_rest``).
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._options: dict[str, str] = {}
        self._schema = None
        self.manifest: DataFrame | None = None

    def format(self, file_type: str) -> "Reader":
        """Same as ``option("fileType", file_type)``."""
        return self.option("fileType", file_type)

    def option(self, key: str, value) -> "Reader":
        self._options[key] = value
        return self

    def options(self, **opts) -> "Reader":
        self._options.update(opts)
        return self

    def schema(self, schema) -> "Reader":
        self._schema = schema
        return self

    def load(self, path=None) -> DataFrame:
        from .remote import resolve
        from .rest import is_endpoint, read_rest

        path = path or formats.get(self._options, "path")
        opts = {k: v for k, v in self._options.items() if k.lower() != "path"}
        ft = formats.get(opts, "fileType")
        if is_endpoint(path):
            opts = {k: v for k, v in opts.items() if k.lower() != "filetype"}
            return read_rest(self._spark, path, ft, self._schema, **opts)
        path = resolve(self._spark, path, opts)
        df, self.manifest = load_remote(self._spark, path, ft, self._schema, **opts)
        return df
