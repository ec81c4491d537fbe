"""Session-level helpers: where staged data lives, and Hadoop FileSystem calls.

Staging must be a folder every executor can see (HDFS, S3, a shared mount).
The cluster names it in ``spark.checkpoint.dir``; ``lading.staging.dir``
overrides it.  Only when neither is set *and* Spark runs in local mode do we
create one ourselves (tests, notebooks).  No data ever moves through these
helpers: they only create, list, rename and time-stamp files on the driver.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

STAGING_CONF = "lading.staging.dir"


def staging_root(spark: SparkSession) -> str:
    """The shared folder staged objects, manifests and lineage cuts go to."""
    conf = spark.sparkContext.getConf()
    for key in (STAGING_CONF, "spark.checkpoint.dir"):
        value = spark.conf.get(key, None) or conf.get(key, None)
        if value:
            return value.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "no shared staging folder: set spark.checkpoint.dir (or "
            f"{STAGING_CONF}) to a location every executor can reach"
        )
    local = tempfile.mkdtemp(prefix="lading-")  # one process: the machine is the cluster
    spark.sparkContext.setCheckpointDir(local)
    spark.conf.set(STAGING_CONF, local)
    return local


def new_staging_dir(spark: SparkSession, label: str, root: str | None = None) -> str:
    """A fresh, never-reused folder under the staging root."""
    base = (root or staging_root(spark)).rstrip("/")
    return f"{base}/lading/{label}-{uuid.uuid4().hex}"


def _jvm_path(spark: SparkSession, uri: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, path


def qualify(spark: SparkSession, uri: str) -> str:
    """Fully qualified URI (adds ``file:`` or the default FS scheme)."""
    fs, path = _jvm_path(spark, uri)
    return str(fs.makeQualified(path).toString())


def exists(spark: SparkSession, uri: str) -> bool:
    fs, path = _jvm_path(spark, uri)
    return bool(fs.exists(path))


def delete(spark: SparkSession, uri: str, recursive: bool = True) -> bool:
    fs, path = _jvm_path(spark, uri)
    return bool(fs.delete(path, recursive))


def mkdirs(spark: SparkSession, uri: str) -> None:
    fs, path = _jvm_path(spark, uri)
    fs.mkdirs(path)


def create_new(spark: SparkSession, uri: str) -> bool:
    """Create an empty file; False if it is there already (one of several callers gets True)."""
    fs, path = _jvm_path(spark, uri)
    try:
        fs.create(path, False).close()
    except Exception as exc:  # noqa: BLE001 -- the file systems name it differently
        if not fs.exists(path):
            raise exc
        return False
    return True


def rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, s = _jvm_path(spark, src)
    _, d = _jvm_path(spark, dst)
    if not fs.rename(s, d):
        raise OSError(f"rename failed: {src} -> {dst}")


def swap(spark: SparkSession, new: str, target: str) -> None:
    """Put ``new`` in the place of ``target``: old data goes only when the new data stands there."""
    if not exists(spark, target):
        mkdirs(spark, target.rstrip("/").rsplit("/", 1)[0])
        rename(spark, new, target)
        return
    parent, name = target.rstrip("/").rsplit("/", 1)
    old = f"{parent}/.{name}-{uuid.uuid4().hex}.old"
    rename(spark, target, old)
    try:
        rename(spark, new, target)
    except Exception:
        rename(spark, old, target)
        raise
    delete(spark, old)


def clear_staging(spark: SparkSession, root: str | None = None) -> int:
    """Remove every folder this library staged under ``root``; call it when no result reads them."""
    base = f"{(root or staging_root(spark)).rstrip('/')}/lading"
    folders = subdirs(spark, base) if exists(spark, base) else []
    return sum(delete(spark, folder) for folder in folders)


def data_files(spark: SparkSession, uri: str) -> list[str]:
    """Visible data files directly under ``uri`` (no _SUCCESS, .crc, hidden)."""
    fs, path = _jvm_path(spark, uri)
    out = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if status.isFile() and not name.startswith(("_", ".")) and not name.endswith(".crc"):
            out.append(str(status.getPath().toString()))
    return sorted(out)


def subdirs(spark: SparkSession, uri: str) -> list[str]:
    """Immediate child folders of ``uri`` (visible ones only)."""
    fs, path = _jvm_path(spark, uri)
    return sorted(str(st.getPath().toString()) for st in fs.listStatus(path)
                  if st.isDirectory() and not st.getPath().getName().startswith(("_", ".")))


def set_mtime(spark: SparkSession, uri: str, epoch_ms: int) -> None:
    """Set the modification time of every file under ``uri`` (metadata only)."""
    fs, path = _jvm_path(spark, uri)
    it = fs.listFiles(path, True)
    while it.hasNext():
        fs.setTimes(it.next().getPath(), int(epoch_ms), -1)
    if fs.getFileStatus(path).isDirectory():
        fs.setTimes(path, int(epoch_ms), -1)
