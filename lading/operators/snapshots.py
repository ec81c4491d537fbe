"""Staging in ranges, and a store of staged objects that keeps its versions.

``copy_ranges`` copies objects of any size by byte ranges, each a row and so a
task's share of its own.  A range goes to its place in a partial file, is read
back and compared by checksum, and is noted in a log; a later try, or a later
call with the same work folder, copies only the ranges that the log lacks.  An
object moves to its name once all its ranges are there.

``stage_snapshot`` keeps a folder of staged objects with a manifest per version.
Staging again copies only objects that are new or changed (by length and
modification time); the others stay where an earlier version put them.  A
version is complete or not there: its manifest is written aside and then renamed.
Older versions can be read until ``expire_snapshots`` removes what only they hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import session
from . import objects

RANGE_BYTES = 128 << 20

RANGE_LOG = T.StructType([
    T.StructField("part", T.StringType()),
    T.StructField("at", T.LongType()),
    T.StructField("n", T.LongType()),
    T.StructField("crc32", T.LongType()),
    T.StructField("error", T.StringType()),
])

SNAPSHOT = T.StructType([
    T.StructField("uri", T.StringType()),
    T.StructField("rel", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modification_time", T.TimestampType()),
    T.StructField("staged_path", T.StringType()),
    T.StructField("version", T.LongType()),
])


# --- one object, many tasks -----------------------------------------------------------

def read_range(uri: str, at: int, n: int):
    """The bytes ``at .. at + n`` of an object, in chunks."""
    fs, path = objects.arrow_location(uri)
    with fs.open_input_file(path) as src:
        src.seek(at)
        while n:
            buf = src.read(min(objects.CHUNK, n))
            if not buf:
                raise EOFError(f"{uri} is shorter than listed")
            n -= len(buf)
            yield buf


def _place(uri: str, part: str, at: int, n: int, read) -> int:
    """Copy one range to its place in ``part`` and compare what stands there; the checksum."""
    import os
    import zlib

    crc = 0
    with os.fdopen(os.open(part, os.O_WRONLY | os.O_CREAT, 0o666), "wb") as out:
        out.seek(at)
        for chunk in read(uri, at, n):
            out.write(chunk)
            crc = zlib.crc32(chunk, crc)
    back = 0
    for chunk in read_range(part, at, n):
        back = zlib.crc32(chunk, back)
    if back != crc:
        raise OSError(f"bytes {at} to {at + n} of {part} differ from their source")
    return crc


def _range_task(read):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            crcs, errors = [], []
            for uri, part, at, n in zip(*(c.to_pylist() for c in b.columns)):
                try:
                    crcs.append(_place(uri, part, at, n, read))
                    errors.append(None)
                except Exception as exc:  # error as data: the other ranges go on
                    crcs.append(None), errors.append(repr(exc))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(crcs, pa.int64()), pa.array(errors, pa.string())],
                                             names=[f.name for f in RANGE_LOG.fields])

    return run


def _finish(batches):
    """Move whole partial files to their names; a retried task finds its work done."""
    import os

    import pyarrow as pa

    for b in batches:
        errors = []
        for part, target, length, whole, error in zip(*(c.to_pylist() for c in b.columns[2:])):
            try:
                if whole:
                    os.makedirs(os.path.dirname(target), exist_ok=True)
                    if length == 0:
                        open(part, "ab").close()
                    if os.path.exists(part):
                        os.replace(part, target)
                    if os.path.getsize(target) != length:
                        raise OSError(f"{target} has not the {length} bytes of its source")
                errors.append(None if whole else error or "ranges are missing")
            except Exception as exc:
                errors.append(repr(exc))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(3), b.column(4), b.column(1), pa.array(errors, pa.string())],
                                         names=[f.name for f in objects.MANIFEST_SCHEMA.fields])


def copy_ranges(files: DataFrame, roots: list[str], dest_dir: str, work_dir: str, range_bytes: int = RANGE_BYTES,
                parallelism: int | None = None, tries: int = 3, read=read_range, name=None) -> DataFrame:
    """Copy listed files below ``dest_dir`` by ranges of ``range_bytes``; the manifest, a row per file.

    ``work_dir`` holds the partial files and the log of ranges; give the same
    folder again to go on after a lost job.  A range that fails is tried
    ``tries`` times in all and leaves ``error`` in its file's row.  Targets must be
    writable at an offset (local and shared mounts); elsewhere, use ``copy_files``.
    ``read(uri, at, n)`` yields a range's bytes; ``name`` turns the column ``rel``
    into the name below ``dest_dir``.
    """
    spark = files.sparkSession
    for folder in (dest_dir, work_dir):
        if (objects.split_uri(folder)[0] or objects.split_uri(session.qualify(spark, folder))[0]) != "file":
            raise ValueError(f"{folder} cannot be written at an offset: use copy_files")
    dest, work = session.qualify(spark, dest_dir), session.qualify(spark, work_dir).rstrip("/")
    bare = [objects.split_uri(f)[2].rstrip("/") for f in (dest, work)]
    session.mkdirs(spark, f"{work}/parts")
    session.mkdirs(spark, f"{work}/log")
    rel = F.col("rel") if name is None else name(F.col("rel"))
    named = objects.staged_names(spark, files.select("path", "modificationTime"), roots)
    # a changed source is another part, so ranges of two states never mix
    plan = (named.join(files.select("path", "length"), "path")
            .select("path", "modificationTime", "length", F.concat(F.lit(f"{bare[0]}/"), rel).alias("target"),
                    F.concat(F.lit(f"{bare[1]}/parts/"), F.sha1(F.concat_ws("\n", "path", F.unix_micros("modificationTime").cast("string"),
                                                                            F.col("length").cast("string"), rel))).alias("part")))
    plan = objects.materialise(plan, f"{session.new_staging_dir(spark, 'ranges')}/plan")
    ranges = (plan.where("length > 0")
              .withColumn("at", F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(range_bytes))))
              .select("path", "part", "at", F.least(F.lit(range_bytes), F.col("length") - F.col("at")).alias("n")))

    def log():
        return spark.read.schema(RANGE_LOG).option("recursiveFileLookup", "true").parquet(f"{work}/log")

    for _ in range(tries):
        todo = ranges.join(log().where("error IS NULL").select("part", "at", "n"), ["part", "at", "n"], "left_anti")
        todo = objects.materialise(todo.select("path", "part", "at", "n"), f"{session.new_staging_dir(spark, 'ranges')}/todo")
        left = todo.count()
        if not left:
            break
        tasks = min(parallelism or 4 * spark.sparkContext.defaultParallelism, left)
        (todo.repartition(tasks).mapInArrow(_range_task(read), RANGE_LOG)
         .write.parquet(f"{session.new_staging_dir(spark, 'range-log', root=f'{work}/log')}"))
    # a range may be in the log more than once: counted by its place
    have = (log().groupBy("part", "at", "n").agg(F.max(F.col("error").isNull()).alias("done"), F.max("error").alias("error"))
            .groupBy("part").agg(F.sum(F.when(F.col("done"), F.col("n"))).alias("have"),
                                 F.max(F.when(~F.col("done"), F.col("error"))).alias("error")))
    whole = (F.col("length") == 0) | (F.coalesce(F.col("have"), F.lit(0)) == F.col("length"))
    state = plan.join(have, "part", "left").select(
        "path", "modificationTime", "part", "target", "length", whole.alias("whole"), "error")
    n = parallelism or spark.sparkContext.defaultParallelism
    return objects.materialise(state.repartition(n).mapInArrow(_finish, objects.MANIFEST_SCHEMA),
                               f"{session.new_staging_dir(spark, 'ranges')}/manifest")


# --- versions of a staged folder --------------------------------------------------------

def versions(spark: SparkSession, store: str) -> list[int]:
    """The committed versions of a store, oldest first."""
    log = f"{store.rstrip('/')}/_log"
    names = [f.rsplit("/", 1)[-1] for f in session.subdirs(spark, log)] if session.exists(spark, log) else []
    return sorted(int(n) for n in names if n.isdigit())


def snapshot(spark: SparkSession, store: str, version: int | None = None) -> DataFrame:
    """The manifest of a version (default: the newest): ``uri, rel, length, modification_time, staged_path, version``.

    ``version`` of a row is the one that copied the object.
    """
    have = versions(spark, store)
    if version is None and not have:
        return spark.createDataFrame([], SNAPSHOT)
    if version is not None and version not in have:
        raise ValueError(f"{store} has no version {version}")
    return spark.read.schema(SNAPSHOT).parquet(f"{store.rstrip('/')}/_log/{have[-1] if version is None else version:08d}")


def stage_snapshot(spark: SparkSession, uris, store: str, range_bytes: int | None = None,
                   parallelism: int | None = None) -> dict:
    """Stage ``uris`` into ``store`` as its next version; copies only new and changed objects.

    Returns ``{"version", "copied", "kept", "removed"}`` (numbers of objects).  An
    unchanged root makes no new version.  Objects that left the roots leave the
    version, not the store.  If a copy fails, nothing is committed and it raises.
    ``range_bytes`` copies by ranges (``copy_ranges``).  Two writers at once: the
    later one to claim the version raises.
    """
    roots = [uris] if isinstance(uris, str) else list(uris)
    base = session.qualify(spark, store).rstrip("/")
    now = objects.staged_names(spark, objects.listing(spark, roots).select("path", "modificationTime"), roots)
    now = (now.join(objects.listing(spark, roots).select("path", "length"), "path")
           .select(F.col("path").alias("uri"), "rel", "length", F.col("modificationTime").alias("modification_time")))
    now = objects.materialise(now, f"{session.new_staging_dir(spark, 'snapshot')}/now")
    before = snapshot(spark, base)
    same = ["uri", "rel", "length", "modification_time"]
    kept = before.join(now.select(*same), same, "left_semi")
    todo = objects.materialise(now.join(before.select(*same), same, "left_anti"),
                               f"{session.new_staging_dir(spark, 'snapshot')}/todo")
    n_before, n_kept, n_todo = before.count(), kept.count(), todo.count()
    gone = before.join(now.select("uri"), "uri", "left_anti").count()
    done = versions(spark, base)
    if done and not n_todo and n_kept == n_before:
        return {"version": done[-1], "copied": 0, "kept": n_kept, "removed": 0}
    version = _claim(spark, base)

    def named(rel):  # the version is in the file's name, so partition folders stay one tree
        return F.regexp_replace(rel, F.lit(r"([^/]+)$"), F.lit(f"{version:08d}-$1"))

    listed = todo.select(F.col("uri").alias("path"), F.col("modification_time").alias("modificationTime"), "length")
    if range_bytes:
        copied = copy_ranges(listed, roots, f"{base}/data", f"{session.new_staging_dir(spark, 'snapshot')}/work",
                             range_bytes, parallelism, name=named)
    else:
        copied = objects.copy_files(listed, roots, f"{base}/data", parallelism, name=named)
        copied = objects.materialise(copied, f"{session.new_staging_dir(spark, 'snapshot')}/copied")
    failed = objects.failed(copied)
    if not failed.isEmpty():
        first = failed.select("uri", "error").first()
        raise RuntimeError(f"{failed.count()} objects failed to stage, e.g. {first.uri}: {first.error}")
    # a length that differs from the listing is a source that changed meanwhile
    new = (todo.join(copied.select("uri", "staged_path", F.col("length").alias("got")), "uri")
           .select(*same, "staged_path", F.lit(version).cast("long").alias("version"), "got"))
    torn = new.where("got <> length")
    if not torn.isEmpty():
        raise RuntimeError(f"{torn.count()} objects changed while they were staged, e.g. {torn.first().uri}")
    aside = f"{base}/_log/.{version:08d}"
    kept.unionByName(new.drop("got")).write.parquet(aside)
    session.rename(spark, aside, f"{base}/_log/{version:08d}")
    return {"version": version, "copied": n_todo, "kept": n_kept, "removed": gone}


def _claim(spark: SparkSession, base: str) -> int:
    """The next version's number, taken by a file that only one writer can create."""
    session.mkdirs(spark, f"{base}/_log")
    taken = [int(f.rsplit("-", 1)[1]) for f in session.data_files(spark, f"{base}/_log") if "/claim-" in f]
    version = 1 + max([0, *taken, *versions(spark, base)])
    if not session.create_new(spark, f"{base}/_log/claim-{version:08d}"):
        raise RuntimeError(f"version {version} of {base} is being written")
    return version


def read_snapshot(spark: SparkSession, store: str, file_type: str, schema=None, version: int | None = None,
                  **options) -> DataFrame:
    """A version's objects as one frame (default: the newest), partition folders as columns.

    The driver lists the version's paths, as Spark's own file index does.
    """
    from ..sources.files import read_files

    base = session.qualify(spark, store).rstrip("/")
    paths = [r.staged_path for r in snapshot(spark, base, version).select("staged_path").toLocalIterator()]
    if not paths:
        raise FileNotFoundError(f"no objects in {store}")
    return read_files(spark, paths, file_type, schema, basePath=f"{base}/data", **options)


def expire_snapshots(spark: SparkSession, store: str, keep: int = 1) -> int:
    """Drop all but the newest ``keep`` versions and the staged objects that only they hold; how many of these."""
    if keep < 1:
        raise ValueError("keep at least one version")
    base = session.qualify(spark, store).rstrip("/")
    have = versions(spark, base)
    old, live = have[:-keep], have[-keep:]
    if not old:
        return 0

    def paths(some):
        return spark.read.schema(SNAPSHOT).parquet(*[f"{base}/_log/{v:08d}" for v in some]).select("staged_path").distinct()

    def remove(batches):
        import pyarrow as pa

        for b in batches:
            for path in b.column(0).to_pylist():
                fs, where = objects.arrow_location(path)
                try:
                    fs.delete_file(where)
                except FileNotFoundError:  # a retried task
                    pass
            yield pa.RecordBatch.from_arrays([b.column(0)], names=["staged_path"])

    gone = objects.materialise(paths(old).join(paths(live), "staged_path", "left_anti"),
                               f"{session.new_staging_dir(spark, 'expired')}/paths")
    for v in old:  # first the versions, so that none names an object that is gone
        session.delete(spark, f"{base}/_log/{v:08d}")
    return gone.mapInArrow(remove, "staged_path string").count()
