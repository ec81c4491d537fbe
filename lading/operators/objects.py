"""Per-object file I/O inside Spark tasks.

Spark's writers produce part files; some connector work needs one file per
object instead (a staged copy of a remote file, a saved HTTP response, an
encrypted or decrypted file).  These helpers run inside ``mapInArrow`` tasks, so
ids and keys keep their exact type, and talk to the shared staging store through ``pyarrow.fs`` (local, HDFS, S3,
GCS, ...).  Each object is written to a temporary name and then moved into
place, so a retried or speculative task rewrites the same final name.
"""

from __future__ import annotations

import re
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, functions as F, types as T

from .. import session

CHUNK = 8 << 20
#: a join that may lose its parts goes in up to so many waves of whole parts, of so many bytes at least
WAVES, WAVE_BYTES = 12, 1 << 30

MANIFEST_SCHEMA = T.StructType([
    T.StructField("uri", T.StringType()),
    T.StructField("staged_path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modification_time", T.TimestampType()),
    T.StructField("error", T.StringType()),
])


# Schemes pyarrow.fs can open directly from a task.
ARROW_SCHEMES = ("", "file", "hdfs", "viewfs", "s3", "s3a", "s3n", "gs", "gcs", "abfs", "abfss")


def split_uri(uri: str) -> tuple[str, str, str]:
    """(scheme, authority, path) of a Hadoop path, which is text: nothing in it is percent-encoded."""
    scheme, authority, path = re.fullmatch(r"(?s)(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/]*))?(.*)", uri).groups()
    return (scheme or "").lower(), authority or "", path


def streamable(uris) -> bool:
    """Whether tasks can stream these locations with pyarrow (checked on the driver)."""
    for uri in uris:
        if split_uri(uri)[0] not in ARROW_SCHEMES:
            return False
        try:
            arrow_location(uri)
        except Exception:  # e.g. HDFS without libhdfs: use the Hadoop path
            return False
    return True


def arrow_location(uri: str):
    """(pyarrow FileSystem, path) for a Hadoop path."""
    import pyarrow.fs as pafs

    scheme, authority, path = split_uri(uri)
    if scheme in ("", "file"):
        return pafs.LocalFileSystem(), path
    if scheme in ("s3a", "s3n"):
        scheme = "s3"
    fs, base = pafs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return fs, base.rstrip("/") + path


def object_name(key) -> str:
    """A file name for a key: one path segment, different for different keys."""
    name = quote(str(key), safe=" !#$&'()+,;=@[]{}~")
    return name.replace(".", "%2E") if name in (".", "..") else name


def _put(fs, path: str, chunks) -> int:
    parent = path.rsplit("/", 1)[0]
    fs.create_dir(parent, recursive=True)
    tmp = f"{parent}/.{path.rsplit('/', 1)[1]}.{uuid.uuid4().hex}.tmp"
    n = 0
    with fs.open_output_stream(tmp) as out:
        for chunk in chunks:
            out.write(chunk)
            n += len(chunk)
    fs.move(tmp, path)
    return n


def write_bytes(uri: str, data: bytes) -> int:
    fs, path = arrow_location(uri)
    return _put(fs, path, [data])


def write_chunks(uri: str, chunks) -> int:
    """Stream chunks of bytes to an object."""
    fs, path = arrow_location(uri)
    return _put(fs, path, chunks)


def copy_stream(src_uri: str, dst_uri: str) -> int:
    """Stream one object to another location without holding it in memory."""
    sfs, spath = arrow_location(src_uri)
    dfs, dpath = arrow_location(dst_uri)

    def chunks():
        with sfs.open_input_stream(spath) as src:
            while True:
                buf = src.read(CHUNK)
                if not buf:
                    return
                yield buf

    return _put(dfs, dpath, chunks())


def write_objects(df: DataFrame, key_col: str, content_col: str, dest_dir: str,
                  suffix: str = "", parallelism: int | None = None,
                  keep: tuple[str, ...] = (), keys_are_paths: bool = False) -> DataFrame:
    """Write each row's ``content_col`` (binary or string) to ``dest_dir/<key><suffix>``.

    A key becomes one path segment (percent-encoded where needed; the manifest
    maps keys to files); two rows with one key raise, they would overwrite each
    other.  With ``keys_are_paths`` keys are relative paths that the caller
    knows to be distinct.  Objects are written where their rows already are (no
    shuffle of payloads); ``parallelism`` re-spreads them by a hash of their key
    first.  Returns a lazy manifest ``(key, *keep, staged_path, length, error)``;
    the caller materialises it (``materialise``) so the files exist exactly once.
    """
    spark = df.sparkSession
    dest = session.qualify(spark, dest_dir)
    extra = T.StructType([
        T.StructField("staged_path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("error", T.StringType()),
    ])
    names = [key_col, *keep]
    out_schema = T.StructType([df.schema[c] for c in names] + extra.fields)
    if not keys_are_paths:
        _raise_on_repeats(df, key_col)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(key_col)).to_pylist()
            paths, lens, errs = [], [], []
            for key, content in zip(keys, batch.column(batch.schema.get_field_index(content_col))):
                content = content.as_py()
                if key is None or content is None:
                    paths.append(None), lens.append(None)
                    errs.append("null content" if key is not None else "null key")
                    continue
                data = content.encode("utf-8") if isinstance(content, str) else bytes(content)
                target = f"{dest}/{key if keys_are_paths else object_name(key)}{suffix}"
                try:
                    lens.append(write_bytes(target, data))
                    paths.append(target)
                    errs.append(None)
                except Exception as exc:  # error as data, never a lost row
                    paths.append(None), lens.append(None), errs.append(repr(exc))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in names]
                + [pa.array(paths, pa.string()), pa.array(lens, pa.int64()), pa.array(errs, pa.string())],
                names=[f.name for f in out_schema.fields])

    cols = names + ([] if content_col in names else [content_col])
    rows = df.select(*cols)
    if parallelism:
        rows = rows.repartition(parallelism, key_col)
    return rows.mapInArrow(run, out_schema)


def _raise_on_repeats(df: DataFrame, column: str) -> None:
    """Two rows with one name would leave one file."""
    twice = df.groupBy(F.col(column).alias("key")).count().where("key IS NOT NULL AND count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{twice[0]['count']} rows would be written to one file: {column} = {twice[0]['key']!r}")


def materialise(df: DataFrame, where: str) -> DataFrame:
    """Write ``df`` to shared storage once and read it back (cuts lineage).

    Side-effecting plans (fetches, file copies) must not be re-run by later
    actions or by a lost executor's recomputation; a written table is the
    durable boundary.
    """
    df.write.mode("overwrite").parquet(where)
    return df.sparkSession.read.parquet(where)


def listing(spark, uris, recursive: bool = True) -> DataFrame:
    """Metadata-only listing ``(path, modificationTime, length)``; no content is read."""
    paths = [uris] if isinstance(uris, str) else list(uris)
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(paths).select("path", "modificationTime", "length")


class LazyListing:
    """The listing of a written path, made when it is first used: a write alone lists nothing."""

    def __init__(self, spark, path: str):
        self._spark, self._path, self._frame = spark, path, None

    def __getattr__(self, name):
        if name.startswith("__"):
            raise AttributeError(name)
        if self._frame is None:
            self._frame = listing(self._spark, self._path)
        return getattr(self._frame, name)


def under_roots(spark, listing: DataFrame, roots) -> DataFrame:
    """``listing`` plus ``root`` (the longest of ``roots`` a file is under, else null), its ``rank`` and ``rel``.

    An equi-join of every file's parent folders with the roots, so the work
    does not grow with their product.
    """
    qroots = sorted({session.qualify(spark, r).rstrip("/") for r in roots})
    if len(qroots) == 1:  # nothing to look up
        below = F.col("path").startswith(qroots[0] + "/")
        name = F.regexp_extract("path", r"([^/]+)$", 1)
        return (listing.withColumn("rel", F.when(below, F.expr(f"substr(path, {len(qroots[0]) + 2})")).otherwise(name))
                .withColumn("root", F.when(below | (F.col("path") == qroots[0]), F.lit(qroots[0])))
                .withColumn("rank", F.when(F.col("root").isNotNull(), F.lit(0))))
    table = spark.createDataFrame(list(enumerate(qroots)), "rank int, root string")
    parts = F.split("path", "/", -1)
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    found = (listing.select("path", F.explode(above).alias("root")).join(table, "root")
             .groupBy("path").agg(F.max_by(F.struct("root", "rank"), F.length("root")).alias("at")))
    rest = F.expr("substr(path, length(at.root) + 2)")
    return (listing.join(found, "path", "left")
            .withColumn("rel", F.when(F.col("at").isNull() | (rest == ""), F.regexp_extract("path", r"([^/]+)$", 1)).otherwise(rest))
            .withColumn("root", F.col("at.root")).withColumn("rank", F.col("at.rank")).drop("at"))


def staged_names(spark, files: DataFrame, roots) -> DataFrame:
    """``path, modificationTime, rel``: where each file goes, its path below its root.

    With several roots the file name starts with its root's number, so equal
    names of different roots stay two files and partition folders stay one tree.
    """
    named = under_roots(spark, files, roots)
    several = len({session.qualify(spark, r).rstrip("/") for r in roots}) > 1
    if several:
        named = named.withColumn("rel", F.regexp_replace(
            "rel", F.lit(r"([^/]+)$"), F.concat(F.coalesce(F.col("rank").cast("string"), F.lit("x")), F.lit("-$1"))))
    named = named.select("path", "modificationTime", "rel")
    if several:  # files of one root have distinct paths below it
        _raise_on_repeats(named, "rel")
    return named


def copy_files(files: DataFrame, roots: list[str], dest_dir: str,
               parallelism: int | None = None, name=None) -> DataFrame:
    """Copy every listed file below ``dest_dir``, keeping its path relative to its root (``name`` of it, if given)."""
    spark = files.sparkSession
    dest = session.qualify(spark, dest_dir)
    n = parallelism or spark.sparkContext.defaultParallelism

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            targets, lens, errs = [], [], []
            for path, rel in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                try:
                    lens.append(copy_stream(path, f"{dest}/{rel}"))
                    targets.append(f"{dest}/{rel}"), errs.append(None)
                except Exception as exc:
                    targets.append(None), lens.append(None), errs.append(repr(exc))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(targets, pa.string()), pa.array(lens, pa.int64()), batch.column(1),
                 pa.array(errs, pa.string())], names=[f.name for f in MANIFEST_SCHEMA.fields])

    # round-robin over small metadata rows: even file counts per task
    named = staged_names(spark, files, roots)
    if name is not None:
        named = named.withColumn("rel", name(F.col("rel")))
    return named.repartition(n).mapInArrow(run, MANIFEST_SCHEMA)


def join_files(spark, folders: list[str], target: str, range_bytes: int = 128 << 20,
               parallelism: int | None = None, at_offset: bool | None = None,
               frames: dict[int, tuple[int, int]] | None = None, consume: bool = False) -> int:
    """Join the part files of ``folders``, in order, into the one new file ``target``; returns its length.

    ``frames`` says, by the number of a folder, how many bytes are left out at the
    beginning and at the end of each of its parts that has any.
    Each part's place is the sum of the lengths before it.  Where files can be
    written at an offset (local and shared mounts) every range of ``range_bytes``
    goes to its place in a task of its own, and a retried task writes the same
    bytes there again.  Elsewhere, or with ``at_offset=False``, one task streams the
    parts; it copies bytes and encodes nothing.
    With ``consume`` the parts are the caller's to lose: ranges are then placed in
    waves of whole parts, whose files go once all bytes of the wave are placed, so
    parts and target together are little more than the target.
    """
    from pyspark.sql import Window

    target = session.qualify(spark, target)
    parts = None
    for i, folder in enumerate(folders):
        front, back = (frames or {}).get(i, (0, 0))
        found = listing(spark, folder).where("length > 0").select(
            F.lit(i).alias("folder"), "path", F.lit(front).cast("long").alias("front"), (F.col("length") - front - back).alias("length"))
        parts = found if parts is None else parts.unionByName(found)
    number = F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("long")
    order = Window.orderBy("folder", "number", "path")  # one small row a part file
    ranges = (parts.where("length > 0").withColumn("number", number)
              .withColumn("begin", F.sum("length").over(order) - F.col("length"))
              .withColumn("at", F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(range_bytes))))
              .select("path", (F.col("at") + F.col("front")).alias("at"), F.least(F.lit(range_bytes), F.col("length") - F.col("at")).alias("n"),
                      (F.col("begin") + F.col("at")).alias("to"), F.col("begin").alias("part_to")))
    ranges = materialise(ranges, session.new_staging_dir(spark, "join"))
    total = ranges.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    at_offset = split_uri(target)[0] in ("", "file") if at_offset is None else at_offset

    def bytes_of(path, at, n):
        fs, where = arrow_location(path)
        with fs.open_input_file(where) as src:
            src.seek(at)
            while n:
                buf = src.read(min(CHUNK, n))
                if not buf:
                    raise EOFError(f"{path} is shorter than listed")
                n -= len(buf)
                yield buf

    def place(batches):
        import os

        import pyarrow as pa

        for b in batches:
            for path, at, n, to, _ in zip(*(c.to_pylist() for c in b.columns)):
                fd = os.open(split_uri(target)[2], os.O_WRONLY | os.O_CREAT, 0o666)
                with os.fdopen(fd, "wb") as out:
                    out.seek(to)
                    for chunk in bytes_of(path, at, n):
                        out.write(chunk)
            yield pa.RecordBatch.from_arrays([b.column(2)], names=["n"])

    def stream(batches):
        import pyarrow as pa

        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        n = write_chunks(target, (chunk for path, at, n, _, _ in rows for chunk in bytes_of(path, at, n)))
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    def remove(batches):
        import pyarrow as pa

        for b in batches:
            for path in b.column(0).to_pylist():
                fs, where = arrow_location(path)
                folder, name = where.rsplit("/", 1)
                for file in (where, f"{folder}/.{name}.crc"):  # a retried task finds some gone
                    if fs.get_file_info(file).is_file:
                        fs.delete_file(file)
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    summed = lambda df: df.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if at_offset:
        session.mkdirs(spark, target.rsplit("/", 1)[0])
        wave_bytes = max(-(-total // WAVES), WAVE_BYTES) if consume else max(total, 1)
        done = 0
        for wave in range(-(-total // wave_bytes)):
            rows = ranges.where(F.floor(F.col("part_to") / F.lit(wave_bytes)) == wave)
            # one row a task where there are fewer ranges than that
            n = min(parallelism or 4 * spark.sparkContext.defaultParallelism, max(1, rows.count()))
            placed = summed(rows.repartition(n).mapInArrow(place, "n long"))
            done += placed
            if consume and placed == summed(rows):
                summed(rows.where("to = part_to").select("path").repartition(n).mapInArrow(remove, "n long"))
    else:
        done = summed(ranges.repartition(1).sortWithinPartitions("to").mapInArrow(stream, "n long"))
    if done != total:
        raise RuntimeError(f"{done} of {total} bytes were joined into {target}")
    return total


def copy_files_via_spark(spark, files: DataFrame, roots: list[str], dest_dir: str,
                         sources: list[str] | None = None) -> DataFrame:
    """Copy listed files whose scheme only Hadoop reads: ``binaryFile`` content.

    Each object is held in memory once (binaryFile's limit of 2 GB an object
    applies), so this path is for sources pyarrow cannot open.  ``sources``
    narrows what is scanned for content (e.g. only the newest drops); default:
    the roots.
    """
    qroots = sorted({session.qualify(spark, r).rstrip("/") for r in roots})
    content = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
               .load(list(sources or qroots)).select("path", "content")
               .join(staged_names(spark, files, roots), "path"))
    written = write_objects(content, "rel", "content", dest_dir, keep=("path", "modificationTime"), keys_are_paths=True)
    return written.select(F.col("path").alias("uri"), "staged_path", "length",
                          F.col("modificationTime").alias("modification_time"), "error")


def failed(manifest: DataFrame) -> DataFrame:
    return manifest.filter(F.col("error").isNotNull())
