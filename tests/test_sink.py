import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, same_rows
from lading import session
from lading.operators.crypto import read_encrypted, read_encrypted_rows, write_encrypted, write_encrypted_rows
from lading.operators.sink import Writer, deliver, write_files
from lading.plans.tables import ddl
from lading.sources.files import read_files


@pytest.mark.parametrize("table,ft,opts", [
    ("lineitem", "csv", {}),
    ("events", "json", {}),
    ("documents", "json", {}),
    ("documents", "csv", {"multiLine": "true", "escape": '"'}),
    ("documents", "xml", {"rowTag": "doc"}),
    ("embeddings", "json", {}),
    ("embeddings", "avro", {}),
    ("events", "xml", {"rowTag": "event"}),
    ("conversations", "json", {}),
    ("orders", "parquet", {}),
])
def test_round_trip(spark, workdir, table, ft, opts):
    src = spark.read.parquet(f"{SF_SMALL}/{table}.parquet")
    write_files(src, f"{workdir}/{table}", ft, **opts)
    back = read_files(spark, f"{workdir}/{table}", ft, schema=ddl(src), **opts)
    assert same_rows(src, back)


def test_csv_keeps_blanks(spark, workdir):
    src = spark.createDataFrame([(" padded ", 1)], "s string, n int")
    write_files(src, f"{workdir}/b", "csv")
    assert read_files(spark, f"{workdir}/b", "csv", schema="s string, n int").first().s == " padded "


def test_save_modes(spark, workdir):
    src = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    path = f"{workdir}/modes"
    write_files(src, path, "json")
    with pytest.raises(Exception):
        write_files(src, path, "json")               # errorifexists
    write_files(src, path, "json", mode="append")
    assert read_files(spark, path, "json").count() == 50
    write_files(src, path, "json", mode="overwrite")
    assert read_files(spark, path, "json").count() == 25
    write_files(src.limit(1), path, "json", mode="ignore")
    assert read_files(spark, path, "json").count() == 25


def test_single_file_delivery(spark, workdir):
    src = spark.read.parquet(f"{SF_SMALL}/orders.parquet").repartition(6)
    target = f"{workdir}/out/orders.csv"
    manifest = write_files(src, target, "csv", single_file=True)
    assert manifest.count() == 1
    assert session.data_files(spark, f"{workdir}/out") == [session.qualify(spark, target)]
    assert same_rows(src, read_files(spark, target, "csv", schema=ddl(src)))
    with pytest.raises(FileExistsError):
        write_files(src, target, "csv", single_file=True)
    write_files(src.limit(3), target, "csv", single_file=True, mode="overwrite")
    assert read_files(spark, target, "csv").count() == 3


def _bytes(path):
    with open(path, "rb") as f:
        return f.read()


@pytest.mark.parametrize("ft, options", [("csv", {}), ("csv", {"header": "false", "delimiter": "|"}), ("json", {})])
def test_single_file_of_parts_equals_one_tasks_file(spark, workdir, ft, options):
    from lading.operators import sink
    from lading.sources import formats

    src = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").repartition(13, "l_orderkey").sortWithinPartitions("l_orderkey", "l_linenumber")
    write_files(src, f"{workdir}/many.{ft}", ft, single_file=True, keep_order=True, **options)
    one = sink._encode_in_one_task(src.coalesce(1), f"{workdir}/one", ft, formats.write_options(ft, formats.normalise(options)))
    assert _bytes(f"{workdir}/many.{ft}") == _bytes(one.removeprefix("file:"))
    assert same_rows(src, read_files(spark, f"{workdir}/many.{ft}", ft, schema=ddl(src), **options))


@pytest.mark.parametrize("options", [{"rowTag": "r"}, {"rowTag": "row", "rootTag": 'books foo="<row/>"', "declaration": ""},
                                     {"rowTag": "row", "rootTag": "rows", "indent": "", "nullValue": "none"}])
def test_single_xml_file_is_encoded_by_all_tasks(spark, workdir, options, monkeypatch):
    from lading.operators import sink
    from lading.sources import formats

    rows = [(i, [None, "", "a\n<b> é", "</rows>\n<row/>"][i % 4], [i] * (i % 3)) for i in range(40)]
    src = spark.createDataFrame(rows, "n int, s string, l array<int>").repartitionByRange(5, "n").where("n < 20 OR n > 28")
    opts = formats.write_options("xml", formats.normalise(options))
    one = sink._encode_in_one_task(src.coalesce(1), f"{workdir}/one", "xml", opts)
    monkeypatch.setattr(sink, "_encode_in_one_task", None)
    write_files(src, f"{workdir}/many.xml", "xml", single_file=True, **options)
    assert _bytes(f"{workdir}/many.xml") == _bytes(one.removeprefix("file:"))
    write_files(src.where("n < 0"), f"{workdir}/none.xml", "xml", single_file=True, **options)
    assert _bytes(f"{workdir}/none.xml") == b""


@pytest.mark.parametrize("codec", ["gzip", "bzip2", "none"])
def test_single_file_of_compressed_parts(spark, workdir, codec):
    src = spark.read.parquet(f"{SF_SMALL}/customer.parquet").repartition(5)
    end = {"gzip": ".gz", "bzip2": ".bz2"}.get(codec, "")
    write_files(src, f"{workdir}/c.csv{end}", "csv", single_file=True, codec=codec)
    assert same_rows(src, read_files(spark, f"{workdir}/c.csv{end}", "csv", schema=ddl(src)))


def test_parts_are_joined_in_ranges_by_several_tasks(spark, workdir):
    from lading.operators import objects

    src = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").repartition(3)
    src.write.json(f"{workdir}/parts")
    parts = session.data_files(spark, f"{workdir}/parts")
    whole = b"".join(_bytes(p.removeprefix("file:")) for p in parts)
    n = objects.join_files(spark, [f"{workdir}/parts"], f"{workdir}/all.json", range_bytes=10_007, parallelism=7)
    assert n == len(whole) and _bytes(f"{workdir}/all.json") == whole
    objects.join_files(spark, [f"{workdir}/parts"], f"{workdir}/streamed.json", range_bytes=10_007, at_offset=False)
    assert _bytes(f"{workdir}/streamed.json") == whole


def test_joined_parts_go_wave_by_wave(spark, workdir, monkeypatch):
    """The disk never holds all parts beside the whole file."""
    import os

    from lading.operators import objects, sink

    monkeypatch.setattr(objects, "WAVE_BYTES", 1000)
    src = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").repartition(5)
    asked, join = [], objects.join_files
    monkeypatch.setattr(sink.objects, "join_files", lambda *a, **k: asked.append(k) or join(*a, **k))
    for kind in ("csv", "xml"):
        write_files(src, f"{workdir}/one.{kind}", kind, single_file=True, rowTag="row", rootTag="rows")
        assert same_rows(src, read_files(spark, f"{workdir}/one.{kind}", kind, schema=ddl(src), rowTag="row"))
    assert [k["consume"] for k in asked] == [True, True]

    src.write.json(f"{workdir}/parts")
    parts = [p.removeprefix("file:") for p in session.data_files(spark, f"{workdir}/parts")]
    first, made = _bytes(parts[0]), objects.materialise
    monkeypatch.setattr(objects, "materialise", lambda *a: (made(*a), os.remove(parts[-1]))[0])
    with pytest.raises(Exception, match="part-0"):  # the last wave fails, those before are over
        join(spark, [f"{workdir}/parts"], f"{workdir}/all.json", range_bytes=10_007, consume=True)
    assert not any(map(os.path.exists, parts))
    assert _bytes(f"{workdir}/all.json")[:len(first)] == first
    left = [n for n in os.listdir(f"{workdir}/parts") if "part-" in n]
    assert left == [f".{os.path.basename(parts[-1])}.crc"]


def test_single_file_without_rows(spark, workdir):
    none = spark.createDataFrame([], "n int, s string")
    write_files(none, f"{workdir}/none.csv", "csv", single_file=True)
    assert _bytes(f"{workdir}/none.csv") == b"n,s\n"
    write_files(none, f"{workdir}/none.json", "json", single_file=True)
    assert _bytes(f"{workdir}/none.json") == b""


def test_single_file_takes_any_plan(spark, workdir):
    src = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    target = f"{workdir}/li.parquet"
    write_files(src, target, "parquet", single_file=True)
    assert same_rows(src, read_files(spark, target, "parquet"))
    # frames whose size Catalyst can only guess
    one = spark.createDataFrame([(1, "a")], "n int, s string")
    write_files(one, f"{workdir}/one.csv", "csv", single_file=True)
    assert read_files(spark, f"{workdir}/one.csv", "csv").count() == 1
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    joined = src.join(orders, src.l_orderkey == orders.o_orderkey).groupBy("o_orderpriority").count()
    write_files(joined, f"{workdir}/joined.csv", "csv", single_file=True)
    assert read_files(spark, f"{workdir}/joined.csv", "csv").count() == 5


def test_codec_and_writer_builder(spark, workdir):
    src = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    w = Writer(src).option("fileType", "csv").option("codec", "gzip").option("delimiter", "\t")
    manifest = w.mode("overwrite").save(f"{workdir}/c")
    assert all(r.path.endswith(".csv.gz") for r in manifest.collect())
    back = read_files(spark, f"{workdir}/c", "csv", schema=ddl(src), delimiter="\t")
    assert same_rows(src, back)


def test_text_sink_rejects_non_string(spark, workdir):
    with pytest.raises(Exception):
        write_files(spark.range(3), f"{workdir}/t", "txt")
    write_files(spark.range(3).select(F.col("id").cast("string")), f"{workdir}/t2", "txt")
    assert sorted(r.value for r in read_files(spark, f"{workdir}/t2", "txt").collect()) == ["0", "1", "2"]


def test_xml_files_bounded_but_single_file_whole(spark, workdir):
    from lading.sources import formats

    src = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").coalesce(1)
    write_files(src, f"{workdir}/x", "xml", rowTag="r", maxRecordsPerFile="1000")
    assert len(session.data_files(spark, f"{workdir}/x")) == 6
    assert formats.write_options("xml", {})["maxRecordsPerFile"] == str(formats.XML_ROWS_PER_FILE)
    write_files(src, f"{workdir}/one.xml", "xml", single_file=True, rowTag="r", maxRecordsPerFile="1000")
    assert same_rows(src, read_files(spark, f"{workdir}/one.xml", "xml", schema=ddl(src), rowTag="r"))


def test_staged_delivery(spark, workdir):
    from lading.operators.sink import deliver

    src = spark.read.parquet(f"{SF_SMALL}/orders.parquet").repartition(3)
    m = deliver(src, f"{workdir}/target/orders", "json")
    assert m.count() == 3 and m.filter("error IS NOT NULL").count() == 0
    assert same_rows(src, read_files(spark, f"{workdir}/target/orders", "json", schema=ddl(src)))
    with pytest.raises(FileExistsError):
        deliver(src, f"{workdir}/target/orders", "json")
    m = (Writer(src).option("fileType", "parquet").option("singleFile", "true")
         .option("tempLocation", f"{workdir}/tmp").mode("overwrite").save(f"{workdir}/target/o.parquet"))
    assert [r.staged_path.rsplit("/", 1)[1] for r in m.collect()] == ["o.parquet"]
    assert same_rows(src, read_files(spark, f"{workdir}/target/o.parquet", "parquet"))


def test_single_file_keeps_sort_order(spark, workdir):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").repartition(4)
    ordered = li.orderBy(F.col("l_extendedprice").desc()).select("l_orderkey", "l_extendedprice")
    write_files(ordered, f"{workdir}/sorted.csv", "csv", single_file=True, keep_order=True)
    back = [r.l_extendedprice for r in read_files(
        spark, f"{workdir}/sorted.csv", "csv", schema="l_orderkey bigint, l_extendedprice double").collect()]
    assert back == sorted(back, reverse=True) and len(back) == li.count()


def test_writer_partition_by_option(spark, workdir):
    src = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    Writer(src).option("fileType", "parquet").option("partitionBy", "o_orderstatus").save(f"{workdir}/p")
    assert sorted(d.rsplit("=", 1)[1] for d in session.subdirs(spark, f"{workdir}/p")) == ["F", "O", "P"]


@pytest.mark.parametrize("ft,opts", [("json", {}), ("csv", {"multiLine": "true", "escape": '"'}),
                                     ("avro", {}), ("parquet", {})])
def test_carriage_returns_survive(spark, workdir, ft, opts):
    src = spark.createDataFrame([(1, "a\r\nb"), (2, "c\rd"), (3, "e\n")], "id int, t string")
    write_files(src, f"{workdir}/cr_{ft}", ft, **opts)
    assert same_rows(src, read_files(spark, f"{workdir}/cr_{ft}", ft, schema="id int, t string", **opts))


def test_staged_delivery_ignore_and_overwrite(spark, workdir):
    from lading.operators.sink import deliver

    src = spark.read.parquet(f"{SF_SMALL}/region.parquet")
    deliver(src, f"{workdir}/t/r", "json")
    deliver(src.limit(1), f"{workdir}/t/r", "json", mode="ignore")
    assert read_files(spark, f"{workdir}/t/r", "json").count() == 5
    deliver(src.limit(2), f"{workdir}/t/r", "json", mode="overwrite")
    assert read_files(spark, f"{workdir}/t/r", "json").count() == 2


def test_single_file_append_is_refused(spark, workdir):
    src = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    write_files(src, f"{workdir}/n.csv", "csv", single_file=True)
    assert read_files(spark, f"{workdir}/n.csv", "csv").count() == 25
    with pytest.raises(ValueError, match="append"):
        write_files(src, f"{workdir}/n.csv", "csv", single_file=True, mode="append")
    write_files(src.limit(1), f"{workdir}/n.csv", "csv", single_file=True, mode="ignore")
    assert read_files(spark, f"{workdir}/n.csv", "csv").count() == 25


def broken(df):
    """A frame whose last rows fail."""
    return df.withColumn("n_comment", F.when(F.col("n_nationkey") > 20, F.raise_error(F.lit("boom"))).otherwise(F.lit("x")))


def test_failing_overwrite_leaves_the_old_data(spark, workdir):
    src = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    key = "0123456789abcdef"
    ways = {
        "single": lambda df, mode: write_files(df, f"{workdir}/single.csv", "csv", mode, single_file=True),
        "staged": lambda df, mode: deliver(df, f"{workdir}/staged", "json", mode),
        "encrypted": lambda df, mode: write_encrypted(df, f"{workdir}/enc", "json", key=key, mode=mode),
        "rows": lambda df, mode: write_encrypted_rows(df, f"{workdir}/rows", key=key, mode=mode),
    }
    for write in ways.values():
        write(src, "errorifexists")
        with pytest.raises(Exception, match="boom"):
            write(broken(src), "overwrite")
    assert read_files(spark, f"{workdir}/single.csv", "csv").count() == 25
    assert read_files(spark, f"{workdir}/staged", "json").count() == 25
    assert read_encrypted(spark, f"{workdir}/enc", "json", schema=ddl(src), key=key).count() == 25
    assert same_rows(read_encrypted_rows(spark, f"{workdir}/rows", ddl(src), key=key), src)


def test_overwrite_may_read_its_target(spark, workdir):
    src = spark.read.parquet(f"{SF_SMALL}/region.parquet")
    write_files(src, f"{workdir}/r.parquet", "parquet", single_file=True)
    own = read_files(spark, f"{workdir}/r.parquet", "parquet").where("r_regionkey < 2")
    write_files(own, f"{workdir}/r.parquet", "parquet", "overwrite", single_file=True)
    assert read_files(spark, f"{workdir}/r.parquet", "parquet").count() == 2


def test_save_modes_of_staged_and_encrypted_writes(spark, workdir):
    src = spark.read.parquet(f"{SF_SMALL}/region.parquet")
    key = "0123456789abcdef"

    def builder(kind, mode):
        w = Writer(src).option("fileType", "csv").mode(mode).option("partitionBy", "r_name")
        if kind == "staged":
            w = w.option("stage", "true")
        elif kind == "encrypted":
            w = w.option("cryptoKey", key)
        return w.save(f"{workdir}/{kind}")

    def rows(kind):
        if kind == "encrypted":
            return read_encrypted(spark, f"{workdir}/{kind}", "csv", key=key).count()
        return read_files(spark, f"{workdir}/{kind}", "csv").count()

    for kind in ("direct", "staged", "encrypted"):
        for mode, n in (("errorifexists", 5), ("overwrite", 5), ("overwrite", 5), ("ignore", 5), ("append", 10)):
            builder(kind, mode)
            assert rows(kind) == n, (kind, mode)
        with pytest.raises(Exception, match="exist"):
            builder(kind, "error")
        assert all("r_name=" in f for f in session.subdirs(spark, f"{workdir}/{kind}"))
    deliver(src, f"{workdir}/one.csv", "csv", single_file=True)
    with pytest.raises(ValueError, match="append"):
        deliver(src, f"{workdir}/one.csv", "csv", "append", single_file=True)
    with pytest.raises(ValueError, match="partition"):
        write_files(src, f"{workdir}/p.csv", "csv", single_file=True, partition_by="r_name")
