import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, same_rows
from lading.operators.objects import write_bytes
from lading.operators.sink import write_files
from lading.plans.tables import ddl
from lading.sources.files import read_files
from lading.sources.rest import SOURCE_NAME, read_rest, register
from lading.streaming.drops import deliver_stream, stream_files


def test_rest_data_source_rows_and_errors(spark, workdir):
    write_bytes(f"{workdir}/a.json", b'{"v": 1}\n{"v": 2}\n')
    register(spark)
    urls = f"file://{workdir}/a.json,file://{workdir}/missing.json"
    df = spark.read.format(SOURCE_NAME).option("numPartitions", "2").load(urls)
    rows = {r.url.rsplit("/", 1)[1]: r for r in df.collect()}
    assert rows["a.json"].error is None and rows["a.json"].body_text.startswith('{"v": 1}')
    assert rows["missing.json"].error is not None and rows["missing.json"].body_text is None


def test_read_rest_parses_types(spark, workdir):
    write_bytes(f"{workdir}/c.csv", b"a;b\n1;x\n2;y\n")
    df = read_rest(spark, [f"file://{workdir}/c.csv"], "csv", "a int, b string", delimiter=";")
    assert sorted((r.a, r.b) for r in df.collect()) == [(1, "x"), (2, "y")]
    write_bytes(f"{workdir}/t.txt", b"l1\nl2\n")
    assert sorted(r.value for r in read_rest(spark, f"file://{workdir}/t.txt", "txt").collect()) == ["l1", "l2"]


def test_read_rest_staged_formats(spark, workdir):
    src = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    write_files(src, f"{workdir}/n", "parquet", single_file=True)
    df = read_rest(spark, f"file://{workdir}/n", "parquet")
    assert same_rows(src, df)


def test_stream_drops_exactly_once(spark, workdir):
    src = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    write_files(src.filter("year(o_orderdate) < 1995"), f"{workdir}/in/d1", "json")
    schema = ddl(src)
    out, ckpt = f"{workdir}/out", f"{workdir}/ckpt"
    deliver_stream(stream_files(spark, f"{workdir}/in/*", "json", schema), out, "parquet",
                   checkpoint=ckpt).awaitTermination()
    n1 = read_files(spark, out, "parquet").count()
    assert n1 == src.filter("year(o_orderdate) < 1995").count()
    write_files(src.filter("year(o_orderdate) >= 1995"), f"{workdir}/in/d2", "json")
    deliver_stream(stream_files(spark, f"{workdir}/in/*", "json", schema), out, "parquet",
                   checkpoint=ckpt).awaitTermination()
    assert same_rows(read_files(spark, out, "parquet"), src)


def test_read_rest_infers_without_schema(spark, workdir):
    write_bytes(f"{workdir}/j.json", b'{"a": 1, "b": "x"}\n{"a": 2, "b": "y"}\n')
    df = read_rest(spark, [f"file://{workdir}/j.json"], "json")
    assert dict((f.name, f.dataType.simpleString()) for f in df.schema.fields) == {"a": "bigint", "b": "string"}
    write_bytes(f"{workdir}/c.csv", b"a,b\n1,x\n")
    df = read_rest(spark, [f"file://{workdir}/c.csv"], "csv", inferSchema="true")
    assert [(r.a, r.b) for r in df.collect()] == [(1, "x")]


def test_url_filters_prune_requests(spark, workdir):
    from pyspark.sql.datasource import EqualTo, In
    from lading.sources.rest import RestReader

    reader = RestReader({"path": "file:///a,file:///b,file:///c"})
    left = list(reader.pushFilters([In(("url",), ("file:///a", "file:///c")),
                                    EqualTo(("status",), 200)]))
    assert left == [EqualTo(("status",), 200)]
    assert [p.urls for p in reader.partitions()] == [["file:///a"], ["file:///c"]]
    write_bytes(f"{workdir}/a.txt", b"A")
    write_bytes(f"{workdir}/b.txt", b"B")
    register(spark)
    urls = f"file://{workdir}/a.txt,file://{workdir}/b.txt,file://{workdir}/missing"
    df = spark.read.format(SOURCE_NAME).load(urls).filter(F.col("url") == f"file://{workdir}/b.txt")
    assert [r.body_text for r in df.collect()] == ["B"]


def test_stream_avro_and_csv(spark, workdir):
    src = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    write_files(src, f"{workdir}/in/a", "avro")
    q = deliver_stream(stream_files(spark, f"{workdir}/in/*", "avro", src.schema),
                       f"{workdir}/out", "csv", checkpoint=f"{workdir}/ck")
    q.awaitTermination()
    assert same_rows(src, read_files(spark, f"{workdir}/out", "csv", schema=ddl(src)))


def test_stream_to_xml_by_batches(spark, workdir):
    src = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    write_files(src, f"{workdir}/in/a", "json")
    q = deliver_stream(stream_files(spark, f"{workdir}/in/*", "json", src.schema),
                       f"{workdir}/out", "xml", checkpoint=f"{workdir}/ck", rowTag="nation")
    q.awaitTermination()
    back = read_files(spark, f"{workdir}/out", "xml", schema=ddl(src), rowTag="nation")
    assert same_rows(src, back.select(*src.columns))


def test_rest_threads_and_implied_auth(spark, workdir):
    for i in range(6):
        write_bytes(f"{workdir}/t{i}.txt", f"body{i}".encode())
    register(spark)
    urls = ",".join(f"file://{workdir}/t{i}.txt" for i in range(6))
    df = (spark.read.format(SOURCE_NAME).option("threads", "3").option("numPartitions", "2")
          .option("token", "abc").load(urls))
    assert sorted(r.body_text for r in df.collect()) == [f"body{i}" for i in range(6)]


def test_rest_bodies_are_scanned_like_files(spark, workdir):
    import pytest

    write_bytes(f"{workdir}/arr.json", b'[{"id": 1},\n {"id": 2}]')
    write_bytes(f"{workdir}/line.json", b'[{"id":1},{"id":2}]\n')
    write_bytes(f"{workdir}/a,b.csv", b"n,t\n1,'x,\ny'\n")
    write_bytes(f"{workdir}/t.txt", b"a\n\nb\n")
    url = lambda n: f"file://{workdir}/{n}"
    assert sorted(r.id for r in read_rest(spark, url("arr.json"), "application/json").collect()) == [1, 2]
    assert sorted(r.id for r in read_rest(spark, [url("line.json")], "json", "id int").collect()) == [1, 2]
    rows = read_rest(spark, [url("a,b.csv")], "csv", "n int, t string", quote="'", multiLine="true").collect()
    assert [(r.n, r.t) for r in rows] == [(1, "x,\ny")]
    assert [r.value for r in read_rest(spark, url("t.txt"), "txt").collect()] == ["a", "", "b"]
    both = [url("t.txt"), url("missing.txt")]
    with pytest.raises(RuntimeError, match="1 requests failed"):
        read_rest(spark, both, "txt")
    assert read_rest(spark, both, "txt", on_failed="skip").count() == 3
    table = spark.createDataFrame([(url("t.txt"),)], "url string")
    assert read_rest(spark, table, "txt").count() == 3
    assert read_rest(spark, both).where("error IS NULL").count() == 1


BODIES = [b"", b"\n", b"a", b"a\n", b"\n\na\r\n\rb\r", b"\xef\xbb\xbfmark\n", b"\xff\xfe\n\xc3\xa9\x00", b"x\n" * 300, b"\xe2\x80\xa8\x0b\x85\n",
          b"y" * 400, b"\xef\xbb\xbf"]


@pytest.mark.parametrize("options", [{}, {"wholetext": "true"}, {"lineSep": "a"}])
def test_small_text_bodies_are_rows_without_files(spark, workdir, options, monkeypatch):
    from lading import session
    from lading.sources import rest

    monkeypatch.setattr(rest, "INLINE_BYTES", 300)
    for i, body in enumerate(BODIES):
        write_bytes(f"{workdir}/b/{i}.txt", body)
    ids = [None if i == 2 else f"id/{i} %" for i in range(len(BODIES))]
    requests = spark.createDataFrame([(n, f"file://{workdir}/b/{i}.txt") for i, n in enumerate(ids)], "request_id string, url string")
    want = (read_files(spark, f"{workdir}/b", "txt", **options)
            .selectExpr("int(split(_metadata.file_name, '[.]')[0]) AS i", "hex(value) AS v").collect())
    staged = []
    new = session.new_staging_dir
    monkeypatch.setattr(session, "new_staging_dir", lambda s, label, **k: staged.append(new(s, label, **k)) or staged[-1])
    rows = read_rest(spark, requests, "txt", id_column="key", **options)
    assert rows.columns == ["key", "value"]
    got = rows.selectExpr("key", "hex(value) AS v").collect()
    assert sorted((repr(r.key), r.v) for r in got) == sorted((repr(ids[r.i]), r.v) for r in want)
    files = len(session.data_files(spark, f"{staged[0]}/bodies"))
    assert files == (len(BODIES) if "lineSep" in options else 2)
    small = read_rest(spark, requests.where("url LIKE '%/3.txt'"), "txt", id_column="key", **options)
    assert [(r.key, r.value) for r in small.collect()][:1] == [(ids[3], "\n" if "lineSep" in options else "a\n" if options else "a")]


def test_rows_of_files_know_their_request(spark, workdir):
    write_bytes(f"{workdir}/1.csv", b"n\n1\n2\n")
    write_bytes(f"{workdir}/2.csv", b"n\n3\n")
    table = spark.createDataFrame([("a b", f"file://{workdir}/1.csv"), ("%2E", f"file://{workdir}/2.csv"), ("no", f"file://{workdir}/3.csv")],
                                  "request_id string, url string")
    got = read_rest(spark, table, "csv", "n int", on_failed="skip", id_column="key").collect()
    assert sorted(map(tuple, got)) == [("%2E", 3), ("a b", 1), ("a b", 2)]
    none = read_rest(spark, table.where("request_id = 'no'"), "csv", "n int", on_failed="skip", id_column="key")
    assert none.columns == ["key", "n"] and none.count() == 0


def test_endpoints_with_commas_and_hosts():
    from lading.sources.rest import split_endpoints, with_host

    assert split_endpoints("http://h/x?ids=1,2,https://h/y\nfile:///z") == ["http://h/x?ids=1,2", "https://h/y", "file:///z"]
    assert split_endpoints('["http://h/a,http://b", "c"]') == ["http://h/a,http://b", "c"]
    assert with_host("v1/x", {"host": "api.example", "port": "8443"}) == "https://api.example:8443/v1/x"
    assert with_host("/v1/x", {"Host": "http://h/base/"}) == "http://h/base/v1/x"
    assert with_host("http://o/x", {"host": "h"}) == "http://o/x"


def test_bodies_are_parsed(spark, workdir):
    write_bytes(f"{workdir}/arr.json", b'[{"id": 1, "s": "x"}, {"id": 2}]')
    write_bytes(f"{workdir}/l.json", b'{"id": 3}\n{"id": 4}\n')
    write_bytes(f"{workdir}/c.csv", b"a,b\n1,x\n,y\n")
    write_bytes(f"{workdir}/t.txt", b"a\n\nb\n")
    load = lambda kind, schema, n: read_rest(spark, f"file://{workdir}/{n}", kind, schema).collect()
    assert [tuple(r) for r in load("application/json", "id int, s string", "arr.json")] == [(1, "x"), (2, None)]
    assert [r.id for r in load("json", "id long", "l.json")] == [3, 4]
    assert [tuple(r) for r in load("csv", "a int, b string", "c.csv")] == [(1, "x"), (None, "y")]
    assert [r.value for r in load("txt", None, "t.txt")] == ["a", "", "b"]


TYPED = "d date, t timestamp_ntz, n decimal(9,2), i int, s string"


@pytest.mark.parametrize("name, kind, body, options", [
    ("a.json", "json", '{"d":"2024-02-29","t":"2024-02-29T10:11:12.5","n":1.25,"i":7,"s":12}\n{"i":"x","s":"a\u2028b"}\n\n', {}),
    ("b.json", "application/json", '[{"d":"2024-02-29","n":"3.50"},\n {"s":null}]', {}),
    ("c.csv", "csv", "d,t,n,i,s\r\n2024-02-29,2024-02-29T10:11:12,1.25,7,x\r\nNA,NA,NA,NA,NA\r\n", {"nullValue": "NA"}),
    ("d.csv", "csv", "", {}), ("e.json", "json", "", {}),
])
def test_bodies_read_like_files(spark, workdir, name, kind, body, options):
    write_bytes(f"{workdir}/{name}", body.encode())
    got = read_rest(spark, f"file://{workdir}/{name}", kind, TYPED, **options)
    multi = {"multiLine": "true"} if kind == "application/json" else {}
    want = read_files(spark, f"{workdir}/{name}", kind, TYPED, **multi, **options)
    assert got.schema == want.schema
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert got.count() == (2 if body else 0)


def test_the_data_source_names_what_parses(spark, workdir):
    register(spark)
    with pytest.raises(Exception, match="read_rest"):
        spark.read.format(SOURCE_NAME).option("fileType", "json").schema("id int").load(f"file://{workdir}/x.json").collect()
    with pytest.raises(Exception, match="read_rest"):
        spark.read.format(SOURCE_NAME).option("fileType", "txt").load(f"file://{workdir}/x.txt")


def test_builders_know_endpoints(spark, monkeypatch):
    from lading import Reader, Writer
    from lading.operators import post
    from lading.sources import rest

    seen = []
    monkeypatch.setattr(rest, "read_rest", lambda spark, *a, **k: seen.append((a, k)))
    Reader(spark).format("csv").option("delimiter", ";").option("token", "t").schema("a int").load("https://h/x,http://h/y")
    assert seen.pop() == (("https://h/x,http://h/y", "csv", "a int"), {"delimiter": ";", "token": "t"})
    monkeypatch.setattr(post, "post_rows", lambda df, *a, **k: seen.append((a, k)))
    writer = Writer(spark.range(1)).option("batchRows", "7").option("token", "t").option("headers", '{"A": "b"}')
    writer.mode("append").save("https://h/x")
    args, how = seen.pop()
    assert args[0] == "https://h/x" and how["batch_rows"] == 7 and how["headers"] == {"A": "b"} and how["auth"]["type"] == "bearer"
    with pytest.raises(ValueError, match="append"):
        writer.mode("overwrite").save("https://h/x")
    with pytest.raises(ValueError, match="json"):
        writer.mode("append").format("csv").save("https://h/x")


def receiving(folder, poison=None, refused=None):
    """An opener that keeps every body under its idempotency key; it kills its own worker once at a body with ``poison``."""
    class Opener:
        def open(self, req, timeout=None):
            import email.message
            import io
            import os
            import time
            import urllib.error
            import uuid

            body = req.data.decode()
            headers = {k.lower(): v for k, v in req.header_items()}
            if poison and poison in body and not os.path.exists(f"{folder}/marker"):
                with open(f"{folder}/marker", "w"):
                    pass
                time.sleep(1)
                os.kill(os.getpid(), 9)
            if refused and refused in body and not os.path.exists(f"{folder}/accept"):
                raise urllib.error.HTTPError(req.full_url, 503, "busy", email.message.Message(), None)
            with open(f"{folder}/{headers['idempotency-key']}-{uuid.uuid4().hex}", "w") as f:
                f.write(body)
            out = io.BytesIO(b"ok")
            out.status, out.headers = 200, email.message.Message()
            return out

    return Opener()


def received(folder):
    """Rows received, and bodies a key."""
    import collections
    import json
    import os

    rows, keys = [], collections.Counter()
    for name in os.listdir(folder):
        if "-" in name:
            with open(f"{folder}/{name}") as f:
                rows += json.load(f)
            keys[name.split("-")[0]] += 1
    return sorted(r["id"] for r in rows), keys


def test_a_retried_task_posts_nothing_twice(spark, workdir, tmp_path):
    from lading import post_rows

    rows = spark.range(0, 100, 1, 3).selectExpr("id", "concat('v', id, 'w') AS s")
    try:  # a local session gives a task one try, so its loss loses the job
        post_rows(rows, "http://h/in", f"{workdir}/sent", batch_rows=10, opener=receiving(str(tmp_path), "v57w"), partitions=2)
    except Exception:
        pass
    before = received(str(tmp_path))[1]
    got = post_rows(rows, "http://h/in", f"{workdir}/sent", batch_rows=10, opener=receiving(str(tmp_path)), partitions=2)
    ids, keys = received(str(tmp_path))
    assert before and set(keys.values()) == {1} and ids == list(range(100))
    assert (got.count(), got.agg(F.sum("n_rows")).first()[0]) == (len(keys), 100)
    post_rows(rows, "http://h/in", f"{workdir}/sent", batch_rows=10, opener=receiving(str(tmp_path)))
    assert received(str(tmp_path))[1] == keys


def test_refused_batches_raise_and_are_sent_again(spark, workdir, tmp_path):
    from lading import post_rows

    rows = spark.range(0, 40, 1, 2).selectExpr("id", "concat('v', id, 'w') AS s")
    send = lambda **how: post_rows(rows, "http://h/in", f"{workdir}/sent", batch_rows=8,
                                   opener=receiving(str(tmp_path), refused="v33w"), **how)
    with pytest.raises(RuntimeError, match="1 batches"):
        send()
    assert send(on_failed="row").where("error IS NOT NULL").count() == 1
    (tmp_path / "accept").write_text("")
    assert send().where("error IS NULL").count() == 6
    ids, keys = received(str(tmp_path))
    assert ids == list(range(40)) and set(keys.values()) == {1}


def test_batches_are_bounded_by_rows_and_bytes(spark, workdir, tmp_path):
    from lading import post_rows

    rows = spark.createDataFrame([(0, "x" * 50), (1, "y" * 5000), (2, "z"), (3, None), (3, None)], "id long, s string").coalesce(1)
    got = post_rows(rows, "http://h/in", f"{workdir}/a", batch_rows=2, batch_bytes=1000, opener=receiving(str(tmp_path)))
    assert sorted((r.request_id, r.n_rows) for r in got.collect()) == [("0-0", 1), ("0-1", 1), ("0-2", 2), ("0-3", 1)]
    assert received(str(tmp_path))[0] == [0, 1, 2, 3, 3]
    assert post_rows(rows.limit(0), "http://h/in", f"{workdir}/b", opener=receiving(str(tmp_path))).count() == 0
    with pytest.raises(ValueError, match="form"):
        post_rows(rows, "http://h/in", form="xml")


def test_copy_latest_has_no_meaning_for_streams(spark, workdir):
    import pytest

    with pytest.raises(ValueError, match="copyLatest"):
        stream_files(spark, workdir, "csv", "a int", copyLatest="true")
