import hashlib
import os

import pytest

from lading import session
from lading.operators.objects import failed, listing, write_bytes
from lading.operators.snapshots import (RANGE_LOG, copy_ranges, expire_snapshots, read_range, read_snapshot, snapshot,
                                        stage_snapshot, versions)


def bare(path):
    return path.removeprefix("file:")


def digest(path):
    with open(bare(path), "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def recording(folder, bad=()):
    """A range reader that notes what it is asked for and fails at the places ``bad`` names."""
    def read(uri, at, n):
        import uuid

        with open(f"{folder}/{at}-{uuid.uuid4().hex}", "w") as f:
            f.write(str(os.getpid()))
        if at in bad:
            raise OSError("no answer")
        yield from read_range(uri, at, n)

    return read


def asked(folder):
    found = sorted(int(f.split("-")[0]) for f in os.listdir(folder))
    for f in os.listdir(folder):
        os.remove(f"{folder}/{f}")
    return found


def test_one_object_is_copied_by_ranges_and_only_failed_ranges_again(spark, workdir, tmp_path):
    data = os.urandom(1_000_003)
    write_bytes(f"{workdir}/src/k=1/big.bin", data)
    write_bytes(f"{workdir}/src/empty.bin", b"")
    files = listing(spark, f"{workdir}/src")  # Spark lists no empty files; a caller's own list may
    files = files.unionByName(files.selectExpr("replace(path, 'k=1/big', 'empty') AS path", "modificationTime", "0L AS length"))
    args = (files, [f"{workdir}/src"], f"{workdir}/dst", f"{workdir}/work")
    first = copy_ranges(*args, range_bytes=100_000, tries=2, read=recording(tmp_path, bad=(300_000,)))
    rows = {r.uri.rsplit("/", 1)[1]: r for r in first.collect()}
    assert rows["empty.bin"].error is None and "no answer" in rows["big.bin"].error
    assert not os.path.exists(f"{bare(workdir)}/dst/k=1/big.bin")  # no torn object under its name
    assert asked(tmp_path) == sorted([*range(0, 1_000_003, 100_000), 300_000])  # the second try: only the failed one
    again = copy_ranges(*args, range_bytes=100_000, read=recording(tmp_path))
    assert failed(again).count() == 0 and asked(tmp_path) == [300_000]
    target = f"{workdir}/dst/k=1/big.bin"
    assert digest(target) == hashlib.sha256(data).hexdigest()
    # a call after the move finds everything done
    assert failed(copy_ranges(*args, range_bytes=100_000, read=recording(tmp_path))).count() == 0
    assert asked(tmp_path) == [] and digest(target) == hashlib.sha256(data).hexdigest()


def test_ranges_of_a_changed_source_do_not_mix(spark, workdir):
    for data in (b"a" * 1000, b"b" * 1500):
        write_bytes(f"{workdir}/src/x.bin", data)
        m = copy_ranges(listing(spark, f"{workdir}/src"), [f"{workdir}/src"], f"{workdir}/dst", f"{workdir}/work", range_bytes=300)
        assert m.first().error is None and m.first().length == len(data)
        assert open(f"{bare(workdir)}/dst/x.bin", "rb").read() == data


def test_ranges_are_tasks_and_remote_targets_are_refused(spark, workdir):
    write_bytes(f"{workdir}/src/x.bin", bytes(1000))
    files = listing(spark, f"{workdir}/src")
    copy_ranges(files, [f"{workdir}/src"], f"{workdir}/dst", f"{workdir}/work", range_bytes=100)
    log = spark.read.schema(RANGE_LOG).option("recursiveFileLookup", "true").parquet(f"{workdir}/work/log")
    from pyspark.sql import functions as F

    assert log.count() == 10 and log.select(F.input_file_name()).distinct().count() > 1
    with pytest.raises(ValueError, match="copy_files"):
        copy_ranges(files, [f"{workdir}/src"], "s3a://bucket/x", f"{workdir}/work")


def test_a_snapshot_copies_only_what_is_new_or_changed(spark, workdir):
    root, store = f"{workdir}/root", f"{workdir}/store"
    for y in (2021, 2022, 2023):
        write_bytes(f"{root}/y={y}/part.csv", f"{y}\n".encode())
    assert stage_snapshot(spark, root, store) == {"version": 1, "copied": 3, "kept": 0, "removed": 0}
    assert stage_snapshot(spark, root, store) == {"version": 1, "copied": 0, "kept": 3, "removed": 0}
    write_bytes(f"{root}/y=2022/part.csv", b"changed\n")
    assert stage_snapshot(spark, root, store) == {"version": 2, "copied": 1, "kept": 2, "removed": 0}
    os.remove(f"{bare(root)}/y=2021/part.csv")
    write_bytes(f"{root}/y=2024/part.csv", b"2024\n")
    assert stage_snapshot(spark, root, store, range_bytes=2) == {"version": 3, "copied": 1, "kept": 2, "removed": 1}

    def rows(version=None):
        got = read_snapshot(spark, store, "csv", "v string", version=version, header="false")
        return sorted((r.v, r.y) for r in got.collect())

    assert rows(1) == [("2021", 2021), ("2022", 2022), ("2023", 2023)]
    assert rows(2) == [("2021", 2021), ("2023", 2023), ("changed", 2022)]
    assert rows() == [("2023", 2023), ("2024", 2024), ("changed", 2022)]
    assert versions(spark, store) == [1, 2, 3]
    assert sorted((r.rel, r.version) for r in snapshot(spark, store).collect()) == [
        ("y=2022/part.csv", 2), ("y=2023/part.csv", 1), ("y=2024/part.csv", 3)]
    assert expire_snapshots(spark, store) == 2  # 2021's file and the first state of 2022's
    assert versions(spark, store) == [3] and rows() == [("2023", 2023), ("2024", 2024), ("changed", 2022)]
    with pytest.raises(ValueError, match="no version 1"):
        rows(1)


def test_same_length_change_and_a_lost_writer(spark, workdir):
    root, store = f"{workdir}/root", f"{workdir}/store"
    write_bytes(f"{root}/a.txt", b"one")
    stage_snapshot(spark, root, store)
    write_bytes(f"{root}/a.txt", b"two")
    session.set_mtime(spark, f"{root}/a.txt", 1_900_000_000_000)
    session.create_new(spark, f"{store}/_log/claim-00000002")  # a writer that never came back
    assert stage_snapshot(spark, root, store)["version"] == 3
    assert [r.value for r in read_snapshot(spark, store, "txt").collect()] == ["two"]
    assert [r.value for r in read_snapshot(spark, store, "txt", version=1).collect()] == ["one"]


def test_a_file_can_be_claimed_once(spark, workdir):
    assert session.create_new(spark, f"{workdir}/x") and not session.create_new(spark, f"{workdir}/x")
