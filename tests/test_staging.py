import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, same_rows
from lading import session
from lading.operators.objects import write_bytes
from lading.sources.files import Reader, latest_file, load_remote, read_files, stage_files


def ms(y, m=1, d=1):
    return int(dt.datetime(y, m, d, tzinfo=dt.timezone.utc).timestamp() * 1000)


def test_latest_file_newest_then_path(spark, workdir):
    for name, when in (("a.csv", ms(2020)), ("b.csv", ms(2022)), ("c.csv", ms(2021))):
        write_bytes(f"{workdir}/drop/{name}", b"x\n1\n")
        session.set_mtime(spark, f"{workdir}/drop/{name}", when)
    assert latest_file(spark, f"{workdir}/drop").endswith("/b.csv")
    session.set_mtime(spark, f"{workdir}/drop/c.csv", ms(2022))   # tie: larger path wins
    assert latest_file(spark, f"{workdir}/drop").endswith("/c.csv")


def test_copy_latest_reads_only_newest(spark, workdir):
    write_bytes(f"{workdir}/d/old.csv", b"v\nold\n")
    write_bytes(f"{workdir}/d/new.csv", b"v\nnew\n")
    session.set_mtime(spark, f"{workdir}/d/old.csv", ms(2019))
    session.set_mtime(spark, f"{workdir}/d/new.csv", ms(2023))
    df = Reader(spark).option("fileType", "csv").option("copyLatest", "true").load(f"{workdir}/d")
    assert [r.v for r in df.collect()] == ["new"]
    staged, manifest = load_remote(spark, f"{workdir}/d", "csv", copyLatest="true", stage="true")
    assert [r.v for r in staged.collect()] == ["new"]
    assert manifest.count() == 1 and manifest.first().error is None


def test_stage_files_manifest_and_content(spark, workdir):
    src = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    src.write.partitionBy("o_orderpriority").json(f"{workdir}/remote")
    manifest = stage_files(spark, f"{workdir}/remote", f"{workdir}/staged")
    rows = manifest.collect()
    assert rows and all(r.error is None and r.length > 0 for r in rows)
    assert all("o_orderpriority=" in r.staged_path for r in rows)
    back = spark.read.schema(src.schema).json(f"{workdir}/staged/data")
    assert same_rows(src, back.select(*src.columns))


def test_create_df_false_returns_empty_frame(spark, workdir):
    write_bytes(f"{workdir}/r/x.csv", b"a,b\n1,2\n")
    df, manifest = load_remote(spark, f"{workdir}/r", "csv", schema="a int, b int", createDF="false")
    assert df.count() == 0 and df.columns == ["a", "b"]
    assert manifest.filter(F.col("error").isNull()).count() == 1
    df, _ = load_remote(spark, f"{workdir}/r", "csv", createDF="false")
    assert df.schema.fields == []


def test_staging_root_prefers_session_setting(spark):
    assert session.staging_root(spark) == spark.conf.get("lading.staging.dir").rstrip("/")


def test_hadoop_only_copy_path(spark, workdir):
    from lading.operators.objects import copy_files_via_spark, listing, streamable

    assert streamable(["file:/x", "/y"]) and not streamable(["sftp://h/p"])
    write_bytes(f"{workdir}/src/a/1.txt", b"one")
    write_bytes(f"{workdir}/src/b/2.txt", b"two")
    files = listing(spark, f"{workdir}/src").filter(F.col("path").endswith("1.txt"))
    m = copy_files_via_spark(spark, files, [f"{workdir}/src"], f"{workdir}/dst").collect()
    assert len(m) == 1 and m[0].staged_path.endswith("/dst/a/1.txt") and m[0].length == 3
    assert spark.read.text(f"{workdir}/dst/a/1.txt").first().value == "one"


def test_newest_per_dataset(spark, workdir):
    for ds, names in (("a", ("x1", "x2")), ("b", ("y1", "y2", "y3"))):
        for i, n in enumerate(names):
            write_bytes(f"{workdir}/{ds}/{n}.txt", n.encode())
            session.set_mtime(spark, f"{workdir}/{ds}/{n}.txt", ms(2020 + i))
    # the newest file of b is newer than all of a, yet each dataset keeps its own pick
    got = latest_file(spark, [f"{workdir}/a", f"{workdir}/b"])
    assert [g.rsplit("/", 1)[1] for g in got] == ["x2.txt", "y3.txt"]
    manifest = stage_files(spark, [f"{workdir}/a", f"{workdir}/b"], f"{workdir}/st", latest=True)
    # files of several roots carry their root's number
    assert sorted(r.staged_path.rsplit("/", 1)[1] for r in manifest.collect()) == ["0-x2.txt", "1-y3.txt"]


def test_staging_root_falls_back_to_the_checkpoint_dir(spark):
    saved = spark.conf.get("lading.staging.dir")
    spark.conf.unset("lading.staging.dir")
    try:
        expected = (spark.sparkContext.getConf().get("spark.checkpoint.dir")
                    or spark.sparkContext.getCheckpointDir())
        assert session.staging_root(spark) == expected.rstrip("/")
        assert session.new_staging_dir(spark, "x").startswith(expected.rstrip("/") + "/lading/x-")
    finally:
        spark.conf.set("lading.staging.dir", saved)


def test_reader_latest_drop_and_temp_location_alias(spark, workdir):
    for year in (2021, 2022, 2023):
        write_bytes(f"{workdir}/drops/y={year}/part-0.csv", f"v\n{year}\n".encode())
        write_bytes(f"{workdir}/drops/y={year}/part-1.csv", f"v\n{year + 100}\n".encode())
        session.set_mtime(spark, f"{workdir}/drops/y={year}", ms(year))
    df = (Reader(spark).option("fileType", "csv").option("copyLatest", "true")
          .option("latestBy", "directory").load(f"{workdir}/drops"))
    assert sorted(r.v for r in df.collect()) == ["2023", "2123"]
    reader = (Reader(spark).option("fileType", "csv").option("copyLatest", "true")
              .option("latestBy", "directory").option("hdfsTempLocation", f"{workdir}/tmp"))
    staged = reader.load(f"{workdir}/drops")
    assert sorted(r.v for r in staged.collect()) == ["2023", "2123"]
    assert all(r.staged_path.startswith(session.qualify(spark, f"{workdir}/tmp"))
               for r in reader.manifest.collect())


def test_equal_names_of_two_roots_stay_two_files(spark, workdir):
    for r in ("r1", "r2"):
        write_bytes(f"{workdir}/{r}/k=1/part-0.csv", f"v\n{r}\n".encode())
    manifest = stage_files(spark, [f"{workdir}/r1", f"{workdir}/r2"], f"{workdir}/st")
    assert manifest.count() == 2
    back = read_files(spark, f"{workdir}/st/data", "csv")
    assert sorted((r.v, r.k) for r in back.collect()) == [("r1", 1), ("r2", 1)]


def test_escaped_names_stage(spark, workdir):
    names = ["k=x%3Ay/part.csv", "c#d.csv", "a b?.csv", "p%41.csv"]
    for n in names:
        write_bytes(f"{workdir}/in/{n}", b"v\n1\n")
    got = stage_files(spark, f"{workdir}/in", f"{workdir}/st").collect()
    assert [r.error for r in got] == [None] * 4
    assert sorted(r.staged_path.split("/st/data/")[1] for r in got) == sorted(names)


def test_newest_drop_is_whole(spark, workdir):
    for year in (2023, 2024):
        for region in ("EU", "US"):
            write_bytes(f"{workdir}/drops/{year}/region={region}/p.csv", f"v\n{year}{region}\n".encode())
            session.set_mtime(spark, f"{workdir}/drops/{year}/region={region}", ms(year) + (region == "US"))
    df, _ = load_remote(spark, f"{workdir}/drops", "csv", copyLatest="true", latestBy="directory")
    assert sorted(r.v for r in df.collect()) == ["2024EU", "2024US"]
    df, m = load_remote(spark, f"{workdir}/drops", "csv", copyLatest="true", latestBy="directory", stage="true")
    assert sorted(r.v for r in df.collect()) == ["2024EU", "2024US"] and m.count() == 2


def test_objects_never_overwrite_each_other(spark, workdir):
    from lading.operators.objects import write_objects

    twice = spark.createDataFrame([(5, "a"), (5, "b")], "k long, t string")
    with pytest.raises(ValueError, match="one file"):
        write_objects(twice, "k", "t", f"{workdir}/o")
    odd = spark.createDataFrame([("../up", "1"), ("a/b", "2"), ("..", "3"), (None, "4"), ("n", None)], "k string, t string")
    got = {r.k: r for r in write_objects(odd, "k", "t", f"{workdir}/o").collect()}
    assert got[None].error == "null key" and got["n"].error == "null content"
    home = session.qualify(spark, f"{workdir}/o")
    assert all(r.staged_path.rsplit("/", 1)[0] == home for k, r in got.items() if k not in (None, "n"))


def test_staged_folders_can_be_cleared(spark, workdir):
    root = f"{workdir}/own"
    session.mkdirs(spark, session.new_staging_dir(spark, "x", root))
    assert session.clear_staging(spark, root) == 1 and session.clear_staging(spark, root) == 0
