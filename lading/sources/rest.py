"""REST endpoints as a Spark data source.

``spark.read.format("rest_endpoint").option(...).load("url1,url2")`` yields one
response row per endpoint, fetched on the executors.  It parses no bodies: typed
rows come from ``read_rest``, ``Reader`` or ``responses_to_rows``, through Spark's
own readers.  Its endpoint list is planned on the driver, so it suits tens to
thousands of endpoints.

``read_rest`` takes a list or a whole table of requests: every body is streamed
to staging inside the task that asks for it, and the files are scanned by
Spark's own readers with all their options, so large bodies are split and
columns pruned like any other file.
"""

from __future__ import annotations

import json
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from .. import session
from ..operators import fetch as fetch_ops
from . import formats

SOURCE_NAME = "rest_endpoint"

RESPONSE_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("body_text", T.StringType()),
    T.StructField("body_bytes", T.BinaryType()),
    T.StructField("error", T.StringType()),
    T.StructField("attempts", T.IntegerType()),
])

_AUTH_KEYS = ("auth_type", "username", "password", "client_id", "client_key", "token",
              "token_type", "refresh_token", "refrsh_token", "token_url")


def split_endpoints(raw: str) -> list[str]:
    """A JSON list, or URLs separated by line feeds or by commas that a scheme follows (a comma may be part of a URL)."""
    if raw.lstrip().startswith("["):
        return [str(u) for u in json.loads(raw)]
    return [u.strip() for u in re.split(r"\n|,(?=\s*[A-Za-z][A-Za-z0-9+.-]*:/)", raw) if u.strip()]


def is_endpoint(path: str | None) -> bool:
    return bool(path) and re.match(r"(?i)\s*https?://", path) is not None


def with_host(url: str, options: dict) -> str:
    """A relative endpoint under the ``host`` option (``protocol``, default https, and ``port``)."""
    host = formats.get(options, "host")
    if host is None or re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", url):
        return url
    base = host if "://" in host else f"{formats.get(options, 'protocol', 'https')}://{host}"
    port = formats.get(options, "port")
    return f"{base.rstrip('/')}{f':{port}' if port else ''}/{url.lstrip('/')}"


def _endpoints(options: dict) -> list[str]:
    return [with_host(u, options) for u in split_endpoints(options.get("path") or options.get("endpoints") or "")]


def fetch_options(options: dict) -> dict:
    """The fetch settings among the options, by ``fetch_requests``' names."""
    o = {k.lower(): v for k, v in options.items() if v is not None}
    auth = {k: o[k] for k in _AUTH_KEYS if k in o} or None
    if auth is not None:
        # auth_type as given; otherwise implied by the credentials present
        implied = "bearer" if "token" in auth else "client" if "client_id" in auth else "basic"
        auth["type"] = auth.pop("auth_type", implied)
    return {
        "on_error": o.get("onerror", "row"),
        "connect_timeout_ms": int(o.get("connecttimeoutms", fetch_ops.CONNECT_TIMEOUT_MS)),
        "read_timeout_ms": int(o.get("readtimeoutms", fetch_ops.READ_TIMEOUT_MS)),
        "proxy_host": o.get("proxyhost"),
        "proxy_port": int(o["proxyport"]) if "proxyport" in o else None,
        "auth": auth,
        "retry_count": int(o.get("retry_count", o.get("retrycount", 0))),
        "retry_frequency_s": float(o.get("retry_frequency", o.get("retry_frquencey", 1.0))),
    }


class _Batch(InputPartition):
    def __init__(self, urls):
        super().__init__(json.dumps(urls))
        self.urls = urls


class RestReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options
        self.wanted: set[str] | None = None

    def pushFilters(self, filters):
        """``url = x`` / ``url IN (...)`` prune endpoints before any request is sent.

        Active when ``spark.sql.python.filterPushdown.enabled`` is true; the
        pushed filters are exact, so Spark does not re-check them.
        """
        for f in filters:
            if isinstance(f, (EqualTo, In)) and tuple(f.attribute) == ("url",):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted = values if self.wanted is None else self.wanted & values
            else:
                yield f

    def partitions(self):
        urls = _endpoints(self.options)
        if self.wanted is not None:
            urls = [u for u in urls if u in self.wanted]
        n = int(self.options.get("numpartitions", 0) or 0) or len(urls) or 1
        size = max(1, -(-len(urls) // n))
        return [_Batch(urls[i:i + size]) for i in range(0, len(urls), size)] or [_Batch([])]

    def read(self, partition):
        o = self.options
        headers = json.loads(o["headers"]) if "headers" in o else None
        fetch_one = fetch_ops.make_fetcher(body_mode=o.get("bodymode", "string"), **fetch_options(o))
        body = o.get("body")
        method = "POST" if body else "GET"
        threads = int(o.get("threads", 1))

        def one(url):
            return (url, *fetch_one(url, method, headers, body))

        pool = ThreadPoolExecutor(threads) if threads > 1 else None
        try:
            yield from fetch_ops.in_order(pool, one, partition.urls, 2 * threads)
        finally:
            if pool:
                pool.shutdown()


class RestDataSource(DataSource):
    """Python data source: endpoints in, responses out (options are case-insensitive)."""

    @classmethod
    def name(cls):
        return SOURCE_NAME

    def schema(self):
        if formats.get(self.options, "fileType") is not None:
            raise ValueError(f"{SOURCE_NAME} returns responses; read_rest(spark, endpoints, fileType, schema) or "
                             "Reader(spark).option('fileType', ..).load(endpoints) returns the rows of their bodies")
        return RESPONSE_SCHEMA

    def reader(self, schema):
        self.schema()
        if schema is not None and schema != RESPONSE_SCHEMA:
            raise ValueError(f"{SOURCE_NAME} returns response rows {RESPONSE_SCHEMA.simpleString()}")
        return RestReader({k.lower(): v for k, v in self.options.items()})


PUSHDOWN_CONF = "spark.sql.python.filterPushdown.enabled"


def register(spark: SparkSession) -> None:
    """Register the source; enables Python-source filter pushdown for the session.

    (A reader that implements ``pushFilters`` is refused while that setting is
    off; sources without ``pushFilters`` are unaffected by it.)
    """
    spark.conf.set(PUSHDOWN_CONF, "true")
    spark.dataSource.register(RestDataSource)


#: options of ``read_rest`` that are not for the file reader
_FETCH_KEYS = {*_AUTH_KEYS, "headers", "body", "host", "port", "protocol", "onerror", "connecttimeoutms", "readtimeoutms",
               "proxyhost", "proxyport", "retry_count", "retrycount", "retry_frequency", "retry_frquencey", "threads",
               "numpartitions", "bodymode", "endpoints"}


def request_table(spark: SparkSession, endpoints, options: dict) -> DataFrame:
    """``request_id, url[, method, headers, body]`` from URLs or from a table with a ``url`` column."""
    if isinstance(endpoints, DataFrame):
        if "request_id" in endpoints.columns:
            return endpoints
        sent = [c for c in ("method", "headers", "body") if c in endpoints.columns]
        if not sent:
            return endpoints.withColumn("request_id", F.sha1(F.col("url")))
        whole = F.struct("url", *[F.map_entries(c).alias(c) if c == "headers" else F.col(c) for c in sent])
        return endpoints.withColumn("request_id", F.sha1(F.to_json(whole)))
    urls = split_endpoints(endpoints) if isinstance(endpoints, str) else list(endpoints)
    rows = spark.createDataFrame([(i, with_host(u, options)) for i, u in enumerate(urls)], "request_id long, url string")
    if formats.get(options, "headers"):
        fixed = json.loads(options["headers"]) if isinstance(options["headers"], str) else dict(options["headers"])
        rows = rows.withColumn("headers", F.create_map(*[F.lit(x) for kv in fixed.items() for x in kv]))
    if formats.get(options, "body"):
        rows = rows.withColumn("body", F.lit(formats.get(options, "body")))
    return rows


#: with an id column, text bodies of at most this many bytes stay in the response table
INLINE_BYTES = 256 << 10


def read_rest(spark: SparkSession, endpoints, file_type: str | None = None, schema=None,
              on_failed: str = "raise", opener=None, id_column: str | None = None, **options) -> DataFrame:
    """Fetch endpoints and, with ``file_type``, scan their bodies as files.

    ``endpoints`` is a URL, a list of them or a DataFrame with ``url`` (and
    optionally ``request_id, method, headers, body``).  Bodies are streamed to
    staging and read natively: every reader option applies, a schema is used as
    given or inferred.  ``application/json`` bodies are whole documents (arrays
    or pretty-printed), ``json`` is one value a line.  ``on_failed``: a failed
    request raises, or with ``"skip"`` its rows are left out.

    ``id_column`` adds the ``request_id`` each row came from, first and under that
    name.  Small text bodies are then kept in the staged response table and cut
    into the reader's lines there; only larger ones become files (which
    ``_metadata`` tells of), so that requests may be many and small.
    """
    opts = {k: v for k, v in options.items() if v is not None}
    how = fetch_options(opts)
    requests = request_table(spark, endpoints, opts)
    for name in ("threads", "numPartitions"):
        if formats.get(opts, name):
            how["threads" if name == "threads" else "partitions"] = int(formats.get(opts, name))
    if file_type is None:
        mode = formats.get(opts, "bodyMode", "string")
        got = fetch_ops.fetch_to_staging(requests, body_mode=mode, opener=opener, keep=("url",), **how)
        return got.drop("request_id")
    where = session.new_staging_dir(spark, "rest")
    ft = formats.file_type(file_type)
    reader = {k.lower() for k in opts} - _FETCH_KEYS
    inline = INLINE_BYTES if id_column and ft == "txt" and schema is None and reader <= {"wholetext"} else 0
    answers = fetch_ops.fetch_to_staging(requests, where, body_mode="file", body_dir=f"{where}/bodies", suffix="." + ft,
                                         opener=opener, inline_bytes=inline, **how)
    rows = _scan(spark, answers, f"{where}/bodies", file_type, schema, on_failed, opts)
    if not id_column:
        return rows
    if rows.columns:
        name = F.element_at(F.split("body_text", "/"), -1)
        ids = answers.where("error IS NULL AND body_text IS NOT NULL").select(F.col("request_id").alias("_id"), name.alias("_file"))
        if session.exists(spark, f"{where}/bodies"):
            file = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))  # it is percent-encoded
            named = rows.select(F.struct("*").alias("_row"), file.alias("_file")).join(ids, "_file")
            rows = named.select(F.col("_id").alias(id_column), "_row.*")
        else:
            rows = ids.where("false").select(F.col("_id").alias(id_column)).crossJoin(rows)
    if not inline:
        return rows
    small = answers.where("error IS NULL AND body_bytes IS NOT NULL").select(F.col("request_id").alias(id_column), "body_bytes")
    lines = _text_rows(small, id_column, formats.flag(opts, "wholetext"))
    return rows.unionByName(lines) if session.exists(spark, f"{where}/bodies") else lines


def _text_rows(bodies: DataFrame, id_column: str, whole: bool) -> DataFrame:
    """The rows Spark's text reader gives for each body: bytes as they are, lines ended by \\n, \\r or \\r\\n, no empty body."""
    bodies = bodies.where("octet_length(body_bytes) > 0")
    if whole:
        return bodies.select(id_column, F.col("body_bytes").cast("string").alias("value"))
    mark = F.substring("body_bytes", 1, 3) == F.lit(b"\xef\xbb\xbf")
    # one character a byte, and back
    text = F.decode(F.when(mark, F.expr("substring(body_bytes, 4)")).otherwise(F.col("body_bytes")), "ISO-8859-1")
    parts = F.split(text, "\r\n|\n|\r", -1)
    lines = F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)
    return (bodies.select(id_column, F.explode(lines).alias("_line"))
            .select(id_column, F.encode("_line", "ISO-8859-1").cast("string").alias("value")))


def _scan(spark, manifest: DataFrame, folder: str, file_type: str, schema, on_failed: str, options: dict) -> DataFrame:
    from .files import read_files

    if on_failed not in ("raise", "skip"):
        raise ValueError("on_failed must be 'raise' or 'skip'")
    bad = manifest.where("error IS NOT NULL")
    if on_failed == "raise":
        first = bad.select(F.col("request_id").cast("string").alias("id"), "error").first()
        if first is not None:
            raise RuntimeError(f"{bad.count()} requests failed, e.g. {first.id}: {first.error}")
    reader = {k: v for k, v in options.items() if k.lower() not in _FETCH_KEYS}
    if str(file_type).strip().lower() == "application/json" and formats.get(reader, "multiLine") is None:
        reader["multiLine"] = "true"
    if not session.exists(spark, folder):  # no request, or none that succeeded
        return spark.createDataFrame([], schema or T.StructType([]))
    return read_files(spark, folder, file_type, schema, **reader)


def responses_to_rows(responses: DataFrame, file_type: str, schema=None, on_failed: str = "raise", **options) -> DataFrame:
    """The rows of a response table's bodies: saved as files, then scanned natively with all options.

    Failed responses raise, or with ``on_failed="skip"`` are left out.
    """
    spark = responses.sparkSession
    ft = formats.file_type(file_type)
    where = session.new_staging_dir(spark, "rest-bodies")
    body = "body_bytes" if ft in ("parquet", "avro") else "body_text"
    manifest = fetch_ops.responses_to_files(responses, f"{where}/bodies", body=body, suffix="." + ft)
    return _scan(spark, manifest, f"{where}/bodies", file_type, schema, on_failed, options)
