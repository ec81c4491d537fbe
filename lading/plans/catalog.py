"""Registered queries: one per connector operator, each over the driver tables.

Every query moves a whole driver table through the operator it names (write it
out in a file type, stage it, fetch it, encrypt it, ...) and returns the result
as a DataFrame.  Each writes into a fresh folder under the shared staging root,
so repeated calls never collide.  ``ORACLE`` holds the DuckDB SQL that computes
the same result straight from the parquet tables.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import session
from ..functions.parse import parse_body, parse_token, parse_unlike
from ..operators import objects
from ..operators.crypto import (encrypt_files, read_encrypted, read_encrypted_rows, write_encrypted,
                                write_encrypted_rows)
from ..operators.fetch import (build_requests, fetch_requests, fetch_to_staging,
                               responses_to_files, url_of)
from ..operators.ledger import fetch_with_ledger
from ..operators.post import post_rows
from ..operators.segments import encrypt_segments, read_encrypted_segments
from ..operators.sink import Writer, write_files
from ..operators.snapshots import copy_ranges, read_snapshot, stage_snapshot
from ..sources import formats
from ..sources.files import Reader, load_remote, read_files
from ..sources.ranges import read_csv_ranges, read_xml_ranges
from ..sources.rest import read_rest
from ..streaming.drops import deliver_stream, stream_files
from .tables import ddl, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn
    return register


def _dir(spark: SparkSession, label: str) -> str:
    return session.new_staging_dir(spark, label)


def _round_trip(spark, sf_dir, name, file_type, **options) -> DataFrame:
    """Write a whole table in ``file_type`` and read it back with its declared schema."""
    src = table(spark, sf_dir, name)
    out = f"{_dir(spark, name + '-' + file_type)}/{name}"
    write_files(src, out, file_type, **options)
    return read_files(spark, out, file_type, schema=ddl(src), **options)


# --- step 1: the minimum slice --------------------------------------------------

PRIORITY_COUNTS = "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority"


def priority_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> csv -> declared-schema scan -> count per priority."""
    orders = table(spark, sf_dir, "orders")
    out = f"{_dir(spark, 'orders-csv')}/orders"
    write_files(orders, out, "csv")
    back = read_files(spark, out, "csv", schema=ddl(orders))
    return back.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("scan_custom_schema", "SELECT * FROM orders")
def scan_custom_schema(spark, sf_dir):
    """A declared schema over csv: every declared type of every column comes back."""
    return _round_trip(spark, sf_dir, "orders", "csv")


@query("scan_csv", "SELECT * FROM lineitem")
def scan_csv(spark, sf_dir):
    return _round_trip(spark, sf_dir, "lineitem", "csv")


@query("sink_csv", "SELECT * FROM orders")
def sink_csv(spark, sf_dir):
    return _round_trip(spark, sf_dir, "orders", "csv", delimiter="|")


@query("scan_full", "SELECT * FROM lineitem")
def scan_full(spark, sf_dir):
    """Full scan of a self-describing delivery: every row and column, no schema given."""
    src = table(spark, sf_dir, "lineitem")
    out = f"{_dir(spark, 'lineitem-parquet')}/lineitem"
    write_files(src, out, "parquet", partition_by="l_returnflag")
    return read_files(spark, out, "parquet").select(*src.columns)


@query("read_dispatch", "SELECT * FROM customer")
def read_dispatch(spark, sf_dir):
    """The MIME spelling of a file type resolves to the same native reader."""
    src = table(spark, sf_dir, "customer")
    out = f"{_dir(spark, 'customer-json')}/customer"
    write_files(src, out, "json")
    return read_files(spark, out, "application/json", schema=ddl(src))


WRITE_TYPES = ("csv", "json", "xml", "avro", "parquet")


@query("write_dispatch", "\nUNION ALL\n".join(
    [f"SELECT '{ft}' AS file_type, * FROM part" for ft in WRITE_TYPES]
    + ["SELECT 'txt' AS file_type, NULL AS p_partkey, p_name, NULL AS p_brand, NULL AS p_type, NULL AS p_size, NULL AS p_retailprice FROM part"]))
def write_dispatch(spark, sf_dir):
    """One table through every writer the dispatch offers (text: one column), each read back whole."""
    src = table(spark, sf_dir, "part")
    base = _dir(spark, "part-dispatch")
    out = None
    for ft in WRITE_TYPES:
        extra = {"rowTag": "part"} if ft == "xml" else {}
        write_files(src, f"{base}/{ft}", ft, **extra)
        back = (read_files(spark, f"{base}/{ft}", ft, schema=ddl(src), **extra)
                .select(F.lit(ft).alias("file_type"), *src.columns))
        out = back if out is None else out.unionByName(back)
    write_files(src.select("p_name"), f"{base}/txt", "txt")
    lines = read_files(spark, f"{base}/txt", "txt").select(F.lit("txt").alias("file_type"), F.col("value").alias("p_name"))
    return out.unionByName(lines, allowMissingColumns=True)


@query("scan_no_schema", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
FROM customer""")
def scan_no_schema(spark, sf_dir):
    """No schema, inferSchema off (the default): every csv column is a string."""
    src = table(spark, sf_dir, "customer")
    out = f"{_dir(spark, 'customer-csv')}/customer"
    write_files(src, out, "csv")
    return read_files(spark, out, "csv")


@query("scan_infer_schema", """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer""")
def scan_infer_schema(spark, sf_dir):
    """inferSchema=true types the csv columns from the data."""
    src = table(spark, sf_dir, "customer")
    out = f"{_dir(spark, 'customer-csv')}/customer"
    write_files(src, out, "csv")
    return read_files(spark, out, "csv", inferSchema="true")


# --- step 2: every file type round-trips --------------------------------------

@query("scan_json", "SELECT * FROM events")
def scan_json(spark, sf_dir):
    return _round_trip(spark, sf_dir, "events", "json")


@query("sink_json", "SELECT * FROM documents")
def sink_json(spark, sf_dir):
    return _round_trip(spark, sf_dir, "documents", "json")


@query("scan_parquet", "SELECT * FROM lineitem")
def scan_parquet(spark, sf_dir):
    return _round_trip(spark, sf_dir, "lineitem", "parquet")


@query("sink_parquet", "SELECT * FROM orders")
def sink_parquet(spark, sf_dir):
    """Partitioned parquet delivery; the partition column comes back from the path."""
    src = table(spark, sf_dir, "orders")
    out = f"{_dir(spark, 'orders-parquet')}/orders"
    write_files(src, out, "parquet", partition_by="o_orderpriority")
    return read_files(spark, out, "parquet").select(*src.columns)


@query("scan_xml", "SELECT * FROM pages")
def scan_xml(spark, sf_dir):
    return _round_trip(spark, sf_dir, "pages", "xml", rowTag="page")


@query("sink_xml", "SELECT * FROM documents")
def sink_xml(spark, sf_dir):
    return _round_trip(spark, sf_dir, "documents", "xml", rowTag="doc", rootTag="docs")


@query("scan_avro", "SELECT * FROM embeddings")
def scan_avro(spark, sf_dir):
    return _round_trip(spark, sf_dir, "embeddings", "avro")


@query("sink_avro", "SELECT * FROM events")
def sink_avro(spark, sf_dir):
    return _round_trip(spark, sf_dir, "events", "avro")


@query("scan_text", """
SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY o_orderpriority""")
def scan_text(spark, sf_dir):
    """One string column out as lines, read back as ``value`` lines."""
    src = table(spark, sf_dir, "orders").select("o_orderpriority")
    out = f"{_dir(spark, 'orders-txt')}/priority"
    write_files(src, out, "txt")
    return read_files(spark, out, "txt").groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("sink_text", "SELECT c_name AS value FROM customer")
def sink_text(spark, sf_dir):
    src = table(spark, sf_dir, "customer").select("c_name")
    out = f"{_dir(spark, 'customer-txt')}/names"
    write_files(src, out, "txt")
    return read_files(spark, out, "txt")


# --- step 5: delivery contracts -------------------------------------------------

@query("sink_single_file", "SELECT *, 'lineitem.csv' AS file FROM lineitem")
def sink_single_file(spark, sf_dir):
    """One delivered file, encoded by several tasks: every row comes back, all from the same file."""
    src = table(spark, sf_dir, "lineitem")
    target = f"{_dir(spark, 'lineitem-single')}/lineitem.csv"
    write_files(src.repartition(8), target, "csv", single_file=True)
    back = read_files(spark, target, "csv", schema=ddl(src))
    return back.select("*", F.col("_metadata.file_name").alias("file"))


@query("sink_csv_codec", "SELECT * FROM lineitem")
def sink_csv_codec(spark, sf_dir):
    """csv with the connector's ``codec`` option (gzip), read back transparently."""
    return _round_trip(spark, sf_dir, "lineitem", "csv", codec="gzip")


SAVE_PATHS = ("direct", "staged", "encrypted")


@query("sink_save_mode", """
SELECT kind, phase, s.* FROM supplier s,
  (VALUES ('direct'), ('staged'), ('encrypted')) k(kind),
  (VALUES ('append'), ('append'), ('overwrite')) p(phase)""")
def sink_save_mode(spark, sf_dir):
    """On every writer path: append twice doubles the rows; overwrite twice, then ignore, leaves one copy."""
    src = table(spark, sf_dir, "supplier")
    base, key = _dir(spark, "supplier-modes"), _key_file(spark)
    out = None
    for kind in SAVE_PATHS:
        for phase, modes in (("append", ("errorifexists", "append")), ("overwrite", ("append", "overwrite", "overwrite", "ignore"))):
            where = f"{base}/{kind}-{phase}"
            for mode in modes:
                writer = Writer(src).option("fileType", "json").mode(mode)
                if kind == "staged":
                    writer = writer.option("stage", "true")
                elif kind == "encrypted":
                    writer = writer.option("cryptoKeyFile", key)
                writer.save(where)
            reader = Reader(spark).option("fileType", "json").schema(ddl(src))
            if kind == "encrypted":
                reader = reader.option("cryptoKeyFile", key)
            rows = reader.load(where).select(F.lit(kind).alias("kind"), F.lit(phase).alias("phase"), *src.columns)
            out = rows if out is None else out.unionByName(rows)
    return out


@query("sink_deliver_staged", "SELECT * FROM supplier")
def sink_deliver_staged(spark, sf_dir):
    """Write to a temp location first, then upload one finished file to the target."""
    src = table(spark, sf_dir, "supplier")
    target = f"{_dir(spark, 'deliver-staged')}/supplier.csv"
    temp = _dir(spark, "deliver-temp")
    (Writer(src).option("fileType", "csv").option("singleFile", "true")
     .option("tempLocation", temp).save(target))
    return read_files(spark, target, "csv", schema=ddl(src))


@query("sink_deliver", "SELECT * FROM supplier")
def sink_deliver(spark, sf_dir):
    """Option-builder delivery to a target URI, read back from the target."""
    src = table(spark, sf_dir, "supplier")
    target = f"{_dir(spark, 'deliver')}/supplier"
    Writer(src).option("fileType", "json").mode("overwrite").save(target)
    return read_files(spark, target, "json", schema=ddl(src))


# --- step 6: newest drop, staging, fetch-only -----------------------------------

def year_drops(spark: SparkSession, sf_dir: str, *below: str) -> str:
    """``orders`` as yearly csv drops (with folders for the ``below`` columns), each stamped with its year's end."""
    src = table(spark, sf_dir, "orders")
    root = f"{_dir(spark, 'orders-drops')}/orders"
    write_files(src.withColumn("drop_year", F.year("o_orderdate")), root, "csv",
                partition_by=["drop_year", *below])
    for drop in session.subdirs(spark, root):
        year = int(drop.rsplit("=", 1)[1])
        end = int(datetime.datetime(year + 1, 1, 1).timestamp() * 1000)
        session.set_mtime(spark, drop, end)
    return root


LATEST_YEAR = """
SELECT * FROM orders
WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)"""


@query("latest_file", LATEST_YEAR)
def latest_file_query(spark, sf_dir):
    """copyLatest over drops of several folders each: the newest drop is read whole."""
    src = table(spark, sf_dir, "orders")
    root = year_drops(spark, sf_dir, "o_orderstatus")
    df, _ = load_remote(spark, root, "csv", ddl(src), copyLatest="true", latestBy="directory")
    return df.select(*src.columns)


@query("stage_files", "SELECT * FROM orders")
def stage_files_query(spark, sf_dir):
    """Every drop copied into staging by executor tasks, then scanned natively."""
    root = year_drops(spark, sf_dir)
    src = table(spark, sf_dir, "orders")
    reader = Reader(spark).option("fileType", "csv").option("stage", "true").schema(ddl(src))
    return reader.load(root).select(*src.columns)


@query("stage_latest", LATEST_YEAR)
def stage_latest(spark, sf_dir):
    """copyLatest with staging: only the newest drop is copied, then scanned."""
    root = year_drops(spark, sf_dir)
    src = table(spark, sf_dir, "orders")
    df, _ = load_remote(spark, root, "csv", ddl(src), copyLatest="true", latestBy="directory",
                        stage="true")
    return df.select(*src.columns)


@query("stage_only", "SELECT * FROM orders")
def stage_only(spark, sf_dir):
    """createDF=false: the frame is empty, the objects are staged; the staged copies hold every row."""
    root = year_drops(spark, sf_dir)
    src = table(spark, sf_dir, "orders")
    empty, manifest = load_remote(spark, root, "csv", createDF="false")
    if empty.schema.fields or manifest is None or objects.failed(manifest).count():
        raise RuntimeError("createDF=false must return an empty frame and a manifest of staged objects")
    copies = manifest.select("staged_path").first()[0].split("/drop_year=")[0]
    return read_files(spark, copies, "csv", schema=ddl(src)).select(*src.columns)


@query("stage_two_roots", "SELECT * FROM orders")
def stage_two_roots(spark, sf_dir):
    """Two roots whose files have equal names: both are staged whole."""
    src = table(spark, sf_dir, "orders")
    base = _dir(spark, "two-roots")
    odd = F.col("o_orderkey") % 2 == 1
    for name, part in (("a", src.where(odd)), ("b", src.where(~odd))):
        write_files(part, f"{base}/{name}/orders.csv", "csv", single_file=True)
    df, _ = load_remote(spark, [f"{base}/a", f"{base}/b"], "csv", ddl(src), stage="true")
    return df


@query("stage_ranges", "SELECT * FROM lineitem")
def stage_ranges(spark, sf_dir):
    """One delivered file copied by many tasks, range by range, then scanned."""
    src = table(spark, sf_dir, "lineitem")
    base = _dir(spark, "one-file")
    write_files(src, f"{base}/drop/lineitem.csv", "csv", single_file=True)
    files = objects.listing(spark, f"{base}/drop")
    manifest = copy_ranges(files, [f"{base}/drop"], f"{base}/copy", f"{base}/work", range_bytes=256 << 10)
    if objects.failed(manifest).count():
        raise RuntimeError("a range was not copied")
    return read_files(spark, f"{base}/copy", "csv", schema=ddl(src))


@query("stage_snapshot", """
SELECT *, year(o_orderdate)::INTEGER AS drop_year,
       CASE WHEN year(o_orderdate) % 2 = 0 THEN 1 ELSE 2 END AS version
FROM orders""")
def stage_snapshot_query(spark, sf_dir):
    """Yearly drops staged twice, half of them at a time: the second version copies only what is new."""
    src = table(spark, sf_dir, "orders").withColumn("drop_year", F.year("o_orderdate"))
    root, store = (f"{_dir(spark, 'snapshots')}/{x}" for x in ("orders", "store"))
    for half in (0, 1):
        write_files(src.where(F.col("drop_year") % 2 == half), root, "csv", mode="append", partition_by=["drop_year"])
        stage_snapshot(spark, root, store)
    rows = read_snapshot(spark, store, "csv", ddl(src))
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)-", 1).cast("int")
    return rows.select(*src.columns, number.alias("version"))


@query("stage_escaped_partitions", """
SELECT *, event_type || ':' || CAST(user_id % 3 AS VARCHAR) || '#' AS tag FROM events""")
def stage_escaped_partitions(spark, sf_dir):
    """Partition folders whose names Spark escapes stage under their own names."""
    src = table(spark, sf_dir, "events").withColumn(
        "tag", F.concat(F.col("event_type"), F.lit(":"), (F.col("user_id") % 3).cast("string"), F.lit("#")))
    root = f"{_dir(spark, 'escaped')}/events"
    write_files(src, root, "json", partition_by="tag")
    df, _ = load_remote(spark, root, "json", ddl(src), stage="true")
    return df.select(*src.columns)


# --- steps 7-8: fetch a table of requests ---------------------------------------

def staged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's html saved as its own file; manifest ``(page_id, staged_path, ...)``."""
    pages = table(spark, sf_dir, "pages")
    where = _dir(spark, "pages-files")
    manifest = objects.write_objects(pages, "page_id", "html", f"{where}/pages", ".html")
    return objects.materialise(manifest, f"{where}/_manifest")


def page_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = staged_pages(spark, sf_dir)
    return build_requests(staged, "page_id", url_of(F.col("staged_path")))


@query("fetch_requests", "SELECT page_id, html FROM pages")
def fetch_requests_query(spark, sf_dir):
    """file:// request per page, fetched on the executors, bodies as text."""
    responses = fetch_to_staging(page_requests(spark, sf_dir))
    return responses.select(F.col("request_id").alias("page_id"), F.col("body_text").alias("html"))


@query("fetch_body_mode", "SELECT page_id, md5(html) AS body_md5, CAST(NULL AS VARCHAR) AS body_text FROM pages")
def fetch_body_mode(spark, sf_dir):
    """body_mode='bytes' fills body_bytes, byte for byte, and leaves body_text null."""
    responses = fetch_to_staging(page_requests(spark, sf_dir), body_mode="bytes")
    return responses.select(F.col("request_id").alias("page_id"), F.md5("body_bytes").alias("body_md5"), "body_text")


class Echo:
    """An opener that answers with what it was asked, in the same process: no server, no network."""

    def __init__(self, proxy_host=None, proxy_port=None, read_timeout_ms=None):
        self.made = {"proxy": f"{proxy_host}:{proxy_port}", "read_timeout_ms": read_timeout_ms}

    def open(self, req, timeout=None):
        import email.message
        import io
        import json

        told = self.made | {"method": req.get_method(), "timeout_ms": int(timeout * 1000),
                            "body": req.data.decode() if req.data else None,
                            "headers": {k.lower(): v for k, v in req.header_items()}}
        answer = io.BytesIO(json.dumps(told).encode())
        answer.status, answer.headers = 200, email.message.Message()
        answer.headers["X-Answer-To"] = req.full_url.rsplit("/", 1)[1]
        return answer


TOLD = ("proxy string, read_timeout_ms int, method string, timeout_ms int, body string, "
        "headers map<string,string>")


def echoed(requests: DataFrame, **options) -> DataFrame:
    """Responses of an echo, what it was told as a struct ``told``."""
    answers = fetch_to_staging(requests, opener=Echo, **options)
    return answers.withColumn("told", F.from_json("body_text", TOLD))


@query("fetch_headers", """
SELECT page_id, CAST(page_id AS VARCHAR) AS sent, 'p' || CAST(page_id AS VARCHAR) AS answered FROM pages""")
def fetch_headers(spark, sf_dir):
    """Request headers arrive with each request; response headers come back as a map."""
    pages = table(spark, sf_dir, "pages")
    requests = build_requests(
        pages, "page_id", F.concat(F.lit("http://echo/p"), F.col("page_id")),
        headers=F.create_map(F.lit("X-Page-Id"), F.col("page_id").cast("string")))
    return echoed(requests).select(F.col("request_id").alias("page_id"),
                                   F.col("told.headers")["x-page-id"].alias("sent"),
                                   F.col("headers")["X-Answer-To"].alias("answered"))


@query("fetch_wide_ids", """
SELECT 9007199254740993 + 2 * page_id AS id, CASE WHEN page_id % 2 = 0 THEN 4611686018427387905 + page_id END AS kept,
       html FROM pages""")
def fetch_wide_ids(spark, sf_dir):
    """Ids above 2^53 and kept columns with nulls pass unchanged."""
    staged = staged_pages(spark, sf_dir).select(
        "staged_path", (F.lit(2 ** 53 + 1) + 2 * F.col("page_id")).alias("id"),
        F.when(F.col("page_id") % 2 == 0, F.lit(2 ** 62 + 1) + F.col("page_id")).alias("kept"))
    requests = build_requests(staged, "id", url_of(F.col("staged_path")), keep=("kept",))
    return fetch_to_staging(requests, keep=("kept",)).select(
        F.col("request_id").alias("id"), "kept", F.col("body_text").alias("html"))


MISSING_SQL = """
SELECT page_id, 'present' AS kind, false AS has_error, 1 AS attempts FROM pages
UNION ALL
SELECT page_id, 'missing' AS kind, true AS has_error, {attempts} AS attempts FROM pages"""


def _present_and_missing(spark, sf_dir, retry_count):
    staged = staged_pages(spark, sf_dir)
    url = url_of(F.col("staged_path"))
    kinds = (build_requests(staged, F.struct(F.col("page_id"), F.lit("present").alias("kind")), url)
             .unionByName(build_requests(
                 staged, F.struct(F.col("page_id"), F.lit("missing").alias("kind")),
                 F.concat(url, F.lit(".missing")))))
    kinds = kinds.withColumn("request_id", F.to_json("request_id"))
    responses = fetch_to_staging(kinds, retry_count=retry_count, retry_frequency_s=0.0)
    key = F.from_json("request_id", "page_id bigint, kind string")
    return responses.select(key["page_id"].alias("page_id"), key["kind"].alias("kind"),
                            F.col("error").isNotNull().alias("has_error"), "attempts")


@query("fetch_errors", MISSING_SQL.format(attempts=1))
def fetch_errors(spark, sf_dir):
    """Unreachable objects answer with an error row, never a lost row."""
    return _present_and_missing(spark, sf_dir, 0)


@query("fetch_retry", MISSING_SQL.format(attempts=3))
def fetch_retry(spark, sf_dir):
    """retry_count=2: failures are tried three times, successes once."""
    return _present_and_missing(spark, sf_dir, 2)


@query("fetch_post", """
SELECT conv_id, turn, kind, CASE WHEN kind = 'text' AND length(text) > 0 THEN 'POST' ELSE 'GET' END AS method,
       CASE WHEN kind = 'text' AND length(text) > 0 THEN text END AS body
FROM conversations, (VALUES ('text'), ('empty'), ('none')) k(kind)""")
def fetch_post(spark, sf_dir):
    """A non-empty body makes the request a POST and is sent with it; an empty or null one makes it a GET."""
    conv = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.explode(F.create_map(F.lit("text"), "text", F.lit("empty"), F.lit(""),
                                                  F.lit("none"), F.lit(None).cast("string"))).alias("kind", "sent"))
    requests = build_requests(conv, F.concat_ws("-", "conv_id", "turn", "kind"), F.lit("http://echo/turn"), body="sent",
                              keep=("conv_id", "turn", "kind"))
    return echoed(requests, keep=("conv_id", "turn", "kind")).select(
        "conv_id", "turn", "kind", F.col("told.method").alias("method"), F.col("told.body").alias("body"))


@query("rest_write", "SELECT *, 'POST' AS method, 'application/json' AS sent_as FROM conversations")
def rest_write(spark, sf_dir):
    """Rows posted in batches of at most 100, as the endpoint was told them."""
    conv = table(spark, sf_dir, "conversations")
    told = (post_rows(conv, "http://echo/rows", batch_rows=100, opener=Echo)
            .select(F.from_json("body_text", TOLD).alias("told")))
    rows = told.select(F.explode(F.from_json("told.body", T.ArrayType(conv.schema))).alias("row"),
                       F.col("told.method").alias("method"), F.col("told.headers")["content-type"].alias("sent_as"))
    return rows.select("row.*", "method", "sent_as")


@query("responses_all_kept", """
SELECT page_id, kind, kind = 'present' AS saved, CASE WHEN kind = 'present' THEN html END AS html
FROM pages, (VALUES ('present'), ('missing')) k(kind)""")
def responses_all_kept(spark, sf_dir):
    """Saved and failed responses are all in the manifest; the saved ones hold their bodies."""
    staged = staged_pages(spark, sf_dir)
    url = url_of(F.col("staged_path"))
    kinds = (build_requests(staged, F.concat("page_id", F.lit("-present")), url)
             .unionByName(build_requests(staged, F.concat("page_id", F.lit("-missing")), F.concat(url, F.lit(".missing")))))
    where = _dir(spark, "responses-kept")
    manifest = responses_to_files(fetch_to_staging(kinds), f"{where}/bodies", suffix=".html")
    back = read_files(spark, f"{where}/bodies", "txt", wholetext="true").select(
        F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.html$", 1).alias("request_id"), F.col("value").alias("html"))
    key = F.split("request_id", "-")
    return manifest.join(back, "request_id", "left").select(
        key[0].cast("bigint").alias("page_id"), key[1].alias("kind"), F.col("error").isNull().alias("saved"), "html")


@query("responses_to_files", "SELECT page_id, html FROM pages")
def responses_to_files_query(spark, sf_dir):
    """Fetched bodies saved one file per request, then scanned back whole."""
    responses = fetch_to_staging(page_requests(spark, sf_dir))
    where = _dir(spark, "responses")
    responses_to_files(responses, where, suffix=".html")
    back = read_files(spark, where, "txt", wholetext="true")
    return back.select(
        F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)\.html$", 1).cast("bigint").alias("page_id"),
        F.col("value").alias("html"))


# --- step 9: response bodies to typed columns -----------------------------------

@query("parse_json_body", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def parse_json_body(spark, sf_dir):
    """JSON bodies parsed JVM-side against a declared schema."""
    events = table(spark, sf_dir, "events")
    parsed = parse_body(events, "props", "json", schema="k bigint")
    return parsed.select("event_id", F.col("parsed.k").alias("k"))


@query("parse_json_infer", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def parse_json_infer(spark, sf_dir):
    """No schema given: it is inferred over every body by a distributed scan."""
    events = table(spark, sf_dir, "events")
    parsed = parse_body(events, "props", "json")
    return parsed.select("event_id", F.col("parsed.k").alias("k"))


@query("parse_unlike", """
SELECT event_id, CASE event_id % 6 WHEN 3 THEN 'malformed' WHEN 4 THEN 'xml' WHEN 5 THEN 'malformed' ELSE 'json' END AS kind,
       CASE WHEN event_id % 6 IN (0, 1, 4) THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
       CASE event_id % 6 WHEN 3 THEN substr(props, 1, 4) WHEN 5 THEN '<r><k>' || event_type || '</r>' END AS broken
FROM events""")
def parse_unlike_query(spark, sf_dir):
    """Objects, arrays, texts, xml, and broken ones of either, in one column: all rows come back, broken ones with their text."""
    k = F.get_json_object("props", "$.k")
    bodies = table(spark, sf_dir, "events").select("event_id", F.expr("event_id % 6").alias("m"), "props", "event_type", k.alias("k")).select(
        "event_id", F.when(F.col("m") == 0, F.col("props")).when(F.col("m") == 1, F.concat(F.lit("["), "props", F.lit("]")))
        .when(F.col("m") == 2, F.to_json(F.array("event_type"))).when(F.col("m") == 3, F.substring("props", 1, 4))
        .when(F.col("m") == 4, F.concat(F.lit("<r><k>"), "k", F.lit("</k></r>")))
        .otherwise(F.concat(F.lit("<r><k>"), "event_type", F.lit("</r>"))).alias("body"))
    parsed = parse_unlike(bodies, "body", "k long")
    return parsed.select("event_id", F.col("parsed_kind").alias("kind"),
                         F.coalesce(F.try_variant_get("parsed", "$.k", "bigint"), F.try_variant_get("parsed", "$[0].k", "bigint")).alias("k"),
                         F.when(F.col("parsed_kind") == "malformed", F.col("body")).alias("broken"))


@query("parse_token", """
SELECT c_custkey, c_name AS access_token, c_mktsegment AS token_type,
       CAST(c_nationkey AS VARCHAR) AS expires_in, CAST(c_custkey AS VARCHAR) AS refresh_token
FROM customer""")
def parse_token_query(spark, sf_dir):
    """Token JSON (numeric expires_in) parsed into the four-string token record."""
    cust = table(spark, sf_dir, "customer")
    body = F.to_json(F.struct(F.col("c_name").alias("access_token"),
                              F.col("c_mktsegment").alias("token_type"),
                              F.col("c_nationkey").alias("expires_in"),
                              F.col("c_custkey").cast("string").alias("refresh_token")))
    return cust.select("c_custkey", parse_token(body).alias("t")).select("c_custkey", "t.*")


# --- step 10: REST endpoints as a data source -----------------------------------

def _served(spark, served: str) -> DataFrame:
    """The part files under ``served`` as a table of requests."""
    return objects.listing(spark, served).select(url_of(F.col("path")).alias("url"))


@query("rest_source", "SELECT * FROM events")
def rest_source(spark, sf_dir):
    """Endpoints serving JSON lines: bodies streamed to staging, then a native scan."""
    events = table(spark, sf_dir, "events")
    served = f"{_dir(spark, 'events-endpoint')}/events"
    write_files(events, served, "json")
    return read_rest(spark, _served(spark, served), "json", events.schema)


@query("rest_source_csv", "SELECT * FROM orders")
def rest_source_csv(spark, sf_dir):
    """csv bodies with a header line and custom delimiter."""
    orders = table(spark, sf_dir, "orders")
    served = f"{_dir(spark, 'orders-endpoint')}/orders"
    write_files(orders, served, "csv", delimiter=";")
    return read_rest(spark, _served(spark, served), "csv", orders.schema, delimiter=";")


@query("rest_json_array", "SELECT * FROM events")
def rest_json_array(spark, sf_dir):
    """Endpoints serving JSON arrays of at most 100 values over several lines."""
    events = table(spark, sf_dir, "events")
    pages = (events.groupBy(F.expr("event_id div 100").alias("page"))
             .agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list(F.to_json(F.struct(*events.columns), {"timestampNTZFormat": formats.TS_NTZ_FORMAT})), ",\n"), F.lit("\n]")).alias("body")))
    where = _dir(spark, "events-pages")
    manifest = objects.materialise(objects.write_objects(pages, "page", "body", f"{where}/served", ".json"), f"{where}/_manifest")
    urls = manifest.select(url_of(F.col("staged_path")).alias("url"))
    return read_rest(spark, urls, "application/json", events.schema)


@query("rest_csv_multiline", "SELECT * FROM documents")
def rest_csv_multiline(spark, sf_dir):
    """csv bodies whose quoted fields hold line feeds."""
    docs = table(spark, sf_dir, "documents")
    served = f"{_dir(spark, 'documents-endpoint')}/documents"
    write_files(docs, served, "csv", escape='"')
    return read_rest(spark, _served(spark, served), "csv", docs.schema, multiLine="true", escape='"')


@query("rest_text", """
SELECT c_custkey, line, count(*) AS n
FROM (SELECT c_custkey, unnest(CASE WHEN c_custkey % 3 = 0 THEN ['', c_name] ELSE [c_name] END) AS line FROM customer)
GROUP BY c_custkey, line""")
def rest_text(spark, sf_dir):
    """Text bodies line by line, blank lines kept."""
    cust = table(spark, sf_dir, "customer")
    bodies = cust.select("c_custkey", F.concat(F.when(F.col("c_custkey") % 3 == 0, F.lit("\n")).otherwise(F.lit("")),
                                               "c_name", F.lit("\n")).alias("body"))
    where = _dir(spark, "names")
    spread = 4 * spark.sparkContext.defaultParallelism  # a small table is one partition, and each row a file
    written = objects.write_objects(bodies, "c_custkey", "body", f"{where}/served", ".txt", spread)
    manifest = objects.materialise(written, f"{where}/_manifest")
    requests = manifest.select(F.col("c_custkey").alias("request_id"), url_of(F.col("staged_path")).alias("url"))
    lines = read_rest(spark, requests, "txt", id_column="id")
    return lines.select(F.col("id").cast("bigint").alias("c_custkey"), F.col("value").alias("line")).groupBy("c_custkey", "line").agg(
        F.count(F.lit(1)).alias("n"))


@query("rest_null_ids", "SELECT md5(html) AS body_md5, count(*) AS n FROM pages GROUP BY ALL")
def rest_null_ids(spark, sf_dir):
    """Requests without an id: every body comes back, whatever else shares the null."""
    requests = page_requests(spark, sf_dir).withColumn("request_id", F.when(F.col("request_id") % 3 == 0, F.col("request_id")))
    bodies = read_rest(spark, requests, "txt", id_column="id", wholetext="true")
    return bodies.groupBy(F.md5(F.col("value").cast("binary")).alias("body_md5")).agg(F.count(F.lit(1)).alias("n"))


@query("fetch_resume", "SELECT page_id, html, 1 AS attempts FROM pages")
def fetch_resume(spark, sf_dir):
    """Pages fetched through a ledger: a first run of every third page, then all, which sends only the rest."""
    requests = page_requests(spark, sf_dir)
    ledger = f"{_dir(spark, 'ledger')}/answers"
    fetch_with_ledger(requests.where("request_id % 3 = 0"), ledger)
    got = fetch_with_ledger(requests, ledger)
    return got.select(F.col("request_id").alias("page_id"), F.col("body_text").alias("html"), "attempts")


@query("scan_xml_ranges", "SELECT * FROM lineitem")
def scan_xml_ranges(spark, sf_dir):
    """One xml file of all rows, read by byte ranges that meet at records."""
    items = table(spark, sf_dir, "lineitem")
    one = f"{_dir(spark, 'lineitem-one')}/lineitem.xml"
    write_files(items, one, "xml", single_file=True, rowTag="row", rootTag="rows")
    return read_xml_ranges(spark, one, items.schema, "row", range_bytes=1 << 20)


@query("scan_csv_ranges", "SELECT * FROM documents")
def scan_csv_ranges(spark, sf_dir):
    """One csv file whose quoted texts hold line feeds, read by byte ranges that meet at records."""
    docs = table(spark, sf_dir, "documents")
    one = f"{_dir(spark, 'documents-one')}/documents.csv"
    write_files(docs, one, "csv", single_file=True, escape='"')
    return read_csv_ranges(spark, one, docs.schema, range_bytes=1 << 18, escape='"')


# --- step 11: encrypted drops and deliveries -------------------------------------

def _key_file(spark) -> str:
    where = f"{_dir(spark, 'key')}/key"
    spark.createDataFrame([("default=lading-test-key-0123456789abcdef",)], "value string") \
         .coalesce(1).write.text(where)
    return where


@query("decrypt_scan", "SELECT * FROM documents")
def decrypt_scan(spark, sf_dir):
    """An encrypted json drop: decrypted file by file on executors, then scanned."""
    docs = table(spark, sf_dir, "documents")
    key = _key_file(spark)
    plain = f"{_dir(spark, 'documents-plain')}/documents"
    write_files(docs, plain, "json")
    encrypted = f"{_dir(spark, 'documents-enc')}/documents"
    encrypt_files(spark, plain, encrypted, key, algorithm="AES/GCM/NoPadding")
    return read_encrypted(spark, encrypted, "json", key, schema=ddl(docs),
                          algorithm="AES/GCM/NoPadding")


@query("sink_encrypt", "SELECT * FROM orders")
def sink_encrypt(spark, sf_dir):
    """Encrypted delivery row by row in the JVM, read back through decryption; no plaintext is staged."""
    orders = table(spark, sf_dir, "orders")
    key = _key_file(spark)
    target = f"{_dir(spark, 'orders-enc')}/orders"
    write_encrypted_rows(orders, target, key, algorithm="AES/GCM/NoPadding")
    return read_encrypted_rows(spark, target, ddl(orders), key, algorithm="AES/GCM/NoPadding")


@query("encrypt_partitioned", "SELECT *, lpad(CAST(o_custkey % 100 AS VARCHAR), 3, '0') AS k FROM orders")
def encrypt_partitioned(spark, sf_dir):
    """Encrypted rows by a text key with leading zeros: it comes back as the text it was, in its own column."""
    orders = table(spark, sf_dir, "orders").withColumn("k", F.lpad((F.col("o_custkey") % 100).cast("string"), 3, "0"))
    key = _key_file(spark)
    target = f"{_dir(spark, 'orders-enc')}/orders"
    write_encrypted_rows(orders, target, key, algorithm="AES/GCM/NoPadding", partition_by="k")
    return read_encrypted_rows(spark, target, ddl(orders), key, algorithm="AES/GCM/NoPadding")


@query("encrypt_segments", "SELECT * FROM documents")
def encrypt_segments_query(spark, sf_dir):
    """Json files as encrypted segments, decrypted and parsed segment by segment; nothing is staged in the clear."""
    docs = table(spark, sf_dir, "documents")
    key = _key_file(spark)
    plain = f"{_dir(spark, 'documents-plain')}/documents"
    write_files(docs, plain, "json")
    target = f"{_dir(spark, 'documents-segments')}/documents"
    encrypt_segments(spark, plain, target, key, segment_bytes=1 << 20, lines=True)
    return read_encrypted_segments(spark, target, "json", docs.schema, key)


@query("sink_encrypt_files", "SELECT * FROM orders")
def sink_encrypt_files(spark, sf_dir):
    """Encrypted csv files for other parties (JCE default AES), read back through decryption."""
    orders = table(spark, sf_dir, "orders")
    key = _key_file(spark)
    target = f"{_dir(spark, 'orders-enc')}/orders"
    write_encrypted(orders, target, "csv", key, algorithm="AES")
    return read_encrypted(spark, target, "csv", key, schema=ddl(orders), algorithm="AES")


# --- drops that keep arriving (Structured Streaming) ----------------------------

@query("stream_drops", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS drop_year, count(*) AS n,
       round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY year(o_orderdate)""")
def stream_drops(spark, sf_dir):
    """Yearly csv drops read incrementally and delivered as parquet, exactly once."""
    root = year_drops(spark, sf_dir)
    orders = table(spark, sf_dir, "orders")
    schema = ddl(orders) + ", drop_year int"
    stream = stream_files(spark, root, "csv", schema, maxFilesPerTrigger="4")
    out = f"{_dir(spark, 'orders-stream')}/orders"
    q = deliver_stream(stream, out, "parquet", partition_by="drop_year")
    q.awaitTermination()
    return (read_files(spark, out, "parquet")
            .groupBy("drop_year")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")))


# --- request configuration: credentials, proxy, timeouts -------------------------

def _assert_secret_absent(df: DataFrame, secret: str) -> None:
    plan = df._jdf.queryExecution().toString()
    if secret in plan or any(secret in str(f) for f in df.schema.fields):
        raise AssertionError("a credential leaked into the plan or the schema")


#: made-up credentials of the echo
ECHO_USER, ECHO_WORD = "reader", "made-up-word"


@query("fetch_auth", f"""
SELECT page_id, 'Basic ' || base64(encode('{ECHO_USER}:{ECHO_WORD}')) AS sent FROM pages""")
def fetch_auth(spark, sf_dir):
    """Basic-auth requests: the header reaches the endpoint, and is never in a plan or a request column."""
    auth = {"type": "basic", "username": ECHO_USER, "password": ECHO_WORD}
    pages = table(spark, sf_dir, "pages")
    requests = build_requests(pages, "page_id", F.concat(F.lit("http://echo/p"), F.col("page_id")))
    _assert_secret_absent(fetch_requests(requests, auth=auth, opener=Echo), ECHO_WORD)
    return echoed(requests, auth=auth).select(F.col("request_id").alias("page_id"),
                                              F.col("told.headers")["authorization"].alias("sent"))


@query("fetch_config", """
SELECT page_id, 'proxy.invalid:3128' AS proxy, 2000 AS timeout_ms, 10000 AS read_timeout_ms FROM pages""")
def fetch_config(spark, sf_dir):
    """Proxy and both timeouts reach the opener; per-host concurrency splits the requests."""
    pages = table(spark, sf_dir, "pages")
    requests = build_requests(pages, "page_id", F.concat(F.lit("http://echo/p"), F.col("page_id")))
    got = echoed(requests, proxy_host="proxy.invalid", proxy_port=3128, connect_timeout_ms=2000,
                 read_timeout_ms=10000, threads=4, partitions=4, per_host=2)
    return got.select(F.col("request_id").alias("page_id"), "told.proxy", "told.timeout_ms", "told.read_timeout_ms")


#: requests a second to each host of the query below
ECHO_RATE = 400.0


@query("fetch_rate", "SELECT page_id, 'p' || CAST(page_id AS VARCHAR) AS answered, 1 AS attempts FROM pages")
def fetch_rate(spark, sf_dir):
    """A page a request, dealt to seven hosts, none of which is sent more than its rate."""
    pages = table(spark, sf_dir, "pages")
    url = F.concat(F.lit("http://h"), (F.col("page_id") % 7).cast("string"), F.lit("/p"), F.col("page_id"))
    got = echoed(build_requests(pages, "page_id", url), rate_per_host=ECHO_RATE, per_host=2, threads=4)
    return got.select(F.col("request_id").alias("page_id"), F.col("headers")["X-Answer-To"].alias("answered"), "attempts")
