import email.message
import email.utils
import io
import os
import time
import urllib.error

import pytest
from conftest import same_rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lading.operators import crypto, segments
from lading.operators.fetch import RETRY_WAIT_MAX_S, wait_before_retry
from lading.operators.ledger import answers, fetch_with_ledger
from lading.operators.objects import write_bytes
from lading.sources.rest import read_rest

KEY = "0123456789abcdef0123456789abcdef"


# segmented encryption

def whole_files(spark, path):
    rows = segments.decrypt_segments(spark, path, key=KEY).collect()
    found = {}
    for r in sorted(rows, key=lambda r: r.number):
        found[r.name] = found.get(r.name, b"") + bytes(r.content)
    return found


def test_segments_of_any_size_round_trip(spark, workdir):
    files = {"a/one.bin": bytes(range(256)) * 400, "two.bin": b"", "three.bin": b"x" * 1000, "four.bin": b"y" * 1001}
    for name, data in files.items():
        write_bytes(f"{workdir}/src/{name}", data)
    listed = segments.encrypt_segments(spark, f"{workdir}/src", f"{workdir}/enc", key=KEY, segment_bytes=1000)
    del files["two.bin"]  # Spark's listing has no empty files
    assert {r.name: r.segments for r in listed.collect()} == {"a/one.bin": 103, "three.bin": 1, "four.bin": 2}
    assert whole_files(spark, f"{workdir}/enc") == files
    stored = spark.read.parquet(f"{workdir}/enc")
    assert stored.where(F.length("payload") > 1000 + 28).isEmpty()  # a nonce and a tag each
    assert stored.select(F.substring("payload", 1, 12)).distinct().count() == stored.count()
    assert b"yyyy" not in b"".join(bytes(r.payload) for r in stored.collect())
    with pytest.raises(PySparkException):
        segments.decrypt_segments(spark, f"{workdir}/enc", key=KEY[::-1]).collect()


def test_altered_files_are_refused(spark, workdir):
    for name in ("a.bin", "b.bin"):
        write_bytes(f"{workdir}/src/{name}", name.encode() * 900)
    segments.encrypt_segments(spark, f"{workdir}/src", f"{workdir}/enc", key=KEY, segment_bytes=1000)
    rows = spark.read.parquet(f"{workdir}/enc")
    twist = F.when(F.col("number") == 0, 1).when(F.col("number") == 1, 0).otherwise(F.col("number")).cast("long")
    flip = F.concat(F.substring("payload", 1, 20), F.lit(b"\x00"), F.expr("substring(payload, 22)"))
    other = F.when(F.col("name") == "a.bin", "b.bin").otherwise("a.bin")
    changed = {"truncated": rows.where("number < segments - 1"), "gap": rows.where("number <> 1"),
               "twice": rows.union(rows.where("number = 0 AND name = 'a.bin'")),
               "shorter": rows.where("number < 2").withColumn("segments", F.lit(2).cast("long")),
               "reordered": rows.withColumn("number", twist), "flipped": rows.withColumn("payload", flip),
               "renamed": rows.withColumn("name", other)}
    for name, frame in changed.items():
        frame.write.parquet(f"{workdir}/{name}")
        with pytest.raises((ValueError, PySparkException)):
            segments.decrypt_segments(spark, f"{workdir}/{name}", key=KEY).write.format("noop").mode("overwrite").save()


@pytest.mark.parametrize("segment_bytes", [1, 37, 1 << 20])
def test_lines_are_parsed_segment_by_segment(spark, workdir, segment_bytes):
    text = "id,name\n" + "".join(f"{i},näme {i}\n" for i in range(40)) + "\n99,last without a feed"
    write_bytes(f"{workdir}/csv/one.csv", text.encode())
    write_bytes(f"{workdir}/csv/two.csv", b"id,name\r\n7,crlf\r\n")
    write_bytes(f"{workdir}/txt/one.txt", "é\n\nlast\n".encode())
    write_bytes(f"{workdir}/txt/none.txt", b"")
    for kind in ("csv", "txt"):
        segments.encrypt_segments(spark, f"{workdir}/{kind}", f"{workdir}/{kind}-enc", key=KEY, segment_bytes=segment_bytes, lines=True)
    got = segments.read_encrypted_segments(spark, f"{workdir}/csv-enc", "csv", "id int, name string", key=KEY)
    assert same_rows(got, spark.read.csv(f"{workdir}/csv", header=True, schema="id int, name string"))
    lines = segments.read_encrypted_segments(spark, f"{workdir}/txt-enc", "txt", None, key=KEY)
    assert sorted(r.value for r in lines.collect()) == sorted(r.value for r in spark.read.text(f"{workdir}/txt").collect())


def test_a_file_larger_than_a_value_could_be(spark, workdir):
    """The stand-in of a file beyond 2 GB: thousands of segments, several tasks, plaintext nowhere under the staging root."""
    from lading import session

    rows = spark.range(60_000).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("word"))
    rows.coalesce(1).write.json(f"{workdir}/src")
    before = set(session.subdirs(spark, f"{session.staging_root(spark)}/lading"))
    segments.encrypt_segments(spark, f"{workdir}/src", f"{workdir}/enc", key=KEY, segment_bytes=2000, lines=True)
    assert spark.read.parquet(f"{workdir}/enc").count() > 2000
    got = segments.read_encrypted_segments(spark, f"{workdir}/enc", "json", rows.schema, key=KEY)
    assert got.rdd.getNumPartitions() > 1 and same_rows(got, rows)
    assert set(session.subdirs(spark, f"{session.staging_root(spark)}/lading")) == before
    with pytest.raises(ValueError):
        segments.read_encrypted_segments(spark, f"{workdir}/enc", "xml", "id long", key=KEY, rowTag="row")


# encrypted rows by partition

def test_partitioned_rows_keep_types_and_order(spark, workdir):
    df = spark.createDataFrame([("007", 1.5, 7, "a"), ("7", 2.5, None, "b"), (None, None, 3, "c"), ("x/y", 0.5, 1, None)],
                               "k string, v double, n int, payload string")
    crypto.write_encrypted_rows(df, f"{workdir}/rows", key=KEY, partition_by=["k", "n"])
    back = crypto.read_encrypted_rows(spark, f"{workdir}/rows", df.schema, key=KEY)
    assert back.columns == df.columns and [f.dataType for f in back.schema] == [f.dataType for f in df.schema]
    assert same_rows(df, back)
    assert same_rows(df, crypto.read_encrypted_rows(spark, f"{workdir}/rows", "k string, v double, n int, payload string", key=KEY))
    with pytest.raises(ValueError):
        crypto.write_encrypted_rows(df, f"{workdir}/no", key=KEY, partition_by="payload")


# requests without ids

def test_null_and_odd_ids_keep_their_bodies(spark, workdir):
    for i, text in enumerate(("one", "two", "three", "four")):
        write_bytes(f"{workdir}/served/{i}.txt", text.encode())
    rows = [(None, 0), (None, 1), ("None", 2), ("%null-0", 3), (None, 0)]
    requests = spark.createDataFrame([(k, f"file://{workdir}/served/{i}.txt".replace("file:///", "/")) for k, i in rows],
                                     "request_id string, url string")
    requests = requests.withColumn("url", F.concat(F.lit("file://"), F.regexp_replace("url", "^file:/*", "/")))
    got = sorted(r.value for r in read_rest(spark, requests, "txt").collect())
    assert got == sorted(["one", "two", "three", "four", "one"])


def test_posts_to_one_url_are_told_apart(spark):
    from lading.sources.rest import request_table

    rows = spark.createDataFrame([("http://h/x", "POST", "a"), ("http://h/x", "POST", "b")], "url string, method string, body string")
    assert request_table(spark, rows, {}).select("request_id").distinct().count() == 2


# the ledger

def counting(folder, poison=None):
    """An opener that leaves a file per request; it kills its own worker at ``poison`` until a marker exists."""
    class Opener:
        def open(self, req, timeout=None):
            import uuid

            name = req.full_url.rsplit("/", 1)[1]
            if name == poison and not os.path.exists(f"{folder}/marker"):
                with open(f"{folder}/marker", "w"):
                    pass
                time.sleep(1)  # the other task has answered meanwhile
                os.kill(os.getpid(), 9)
            with open(f"{folder}/{name}-{uuid.uuid4().hex}", "w"):
                pass
            if name.startswith("busy") and len([f for f in os.listdir(folder) if f.startswith(name + "-")]) < 2:
                raise urllib.error.HTTPError(req.full_url, 503, "busy", email.message.Message(), None)
            if name.startswith("gone"):
                raise urllib.error.HTTPError(req.full_url, 404, "gone", email.message.Message(), None)
            out = io.BytesIO(f"body of {name}".encode())
            out.status, out.headers = 200, email.message.Message()
            return out

    return Opener()


def sent(folder):
    names = [f.rsplit("-", 1)[0] for f in os.listdir(folder) if f != "marker"]
    return {n: names.count(n) for n in names}


def requests_of(spark, names):
    return spark.createDataFrame([(i, f"http://h/{n}") for i, n in enumerate(names)], "request_id long, url string")


def test_a_killed_job_resumes(spark, workdir, tmp_path):
    folder, ledger = str(tmp_path), f"{workdir}/ledger"
    requests = requests_of(spark, [f"p{i}" for i in range(30)])
    with pytest.raises(Exception, match="worker"):
        fetch_with_ledger(requests, ledger, opener=counting(folder, "p17"), partitions=2, chunk_rows=1)
    first = sent(folder)
    held = {r.body_text[len("body of "):] for r in answers(spark, ledger).collect()}
    assert 0 < len(held) < 30 and "p17" not in held and set(first) - held <= {n for n in first}
    got = fetch_with_ledger(requests, ledger, opener=counting(folder, "p17"), partitions=2, chunk_rows=1)
    assert sorted((r.request_id, r.body_text) for r in got.collect()) == [(i, f"body of p{i}") for i in range(30)]
    again = sent(folder)
    assert all(again[n] == first[n] for n in held)  # nothing that was answered was sent again
    assert all(again[n] == 1 for n in again if n not in first)


def test_passing_failures_are_sent_again_and_refusals_are_not(spark, workdir, tmp_path):
    folder, ledger = str(tmp_path), f"{workdir}/ledger"
    requests = requests_of(spark, ["ok", "busy1", "gone1", "ok"]).withColumn("extra", F.col("request_id") * 2)
    one = {r.request_id: r for r in fetch_with_ledger(requests, ledger, opener=counting(folder), keep=("extra",)).collect()}
    assert (one[1].status, one[2].status, one[0].body_text, one[3].extra) == (503, 404, "body of ok", 6)
    two = {r.request_id: r for r in fetch_with_ledger(requests, ledger, opener=counting(folder)).collect()}
    assert (two[1].status, two[1].body_text, two[2].status) == (200, "body of busy1", 404)
    assert sent(folder) == {"ok": 2, "busy1": 2, "gone1": 1}  # two ids of one URL are two requests
    with pytest.raises(ValueError):
        fetch_with_ledger(requests, ledger, body_mode="file")


def test_equal_requests_and_none(spark, workdir, tmp_path):
    requests = spark.createDataFrame([(None, "http://h/a"), (None, "http://h/a"), (1, "http://h/b")], "request_id long, url string")
    got = fetch_with_ledger(requests, f"{workdir}/ledger", opener=counting(str(tmp_path)))
    assert sorted(r.body_text for r in got.collect()) == ["body of a", "body of a", "body of b"]
    assert sent(str(tmp_path)) == {"a": 1, "b": 1}
    assert fetch_with_ledger(requests.limit(0), f"{workdir}/none", opener=counting(str(tmp_path))).count() == 0


def test_waits_grow_and_follow_the_endpoint():
    def asked(value):
        headers = email.message.Message()
        headers["Retry-After"] = value
        return urllib.error.HTTPError("http://h", 503, "busy", headers, None)

    assert [wait_before_retry(OSError(), n, 2, 3, 100) for n in (1, 2, 3, 9)] == [2, 6, 18, 100]
    assert wait_before_retry(asked("7"), 1, 1, 1, 100) == 7 and wait_before_retry(asked("7"), 1, 9, 1, 100) == 9
    assert wait_before_retry(asked("9999"), 1, 1, 1, RETRY_WAIT_MAX_S) == RETRY_WAIT_MAX_S
    assert wait_before_retry(asked("soon"), 1, 1, 1, 100) == 1
    later = email.utils.format_datetime(email.utils.datetime.datetime.now(email.utils.datetime.timezone.utc)
                                        + email.utils.datetime.timedelta(seconds=40))
    assert 30 < wait_before_retry(asked(later), 1, 1, 1, 100) <= 40
