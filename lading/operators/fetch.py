"""HTTP fetch as a Spark job: a table of requests in, a table of responses out.

Requests are spread over ``partitions`` small tasks (what a retry repeats) and
fetched on the executors with the standard library.  Failures are data: every
request yields exactly one response row carrying its ``status``, ``error`` and
``attempts``.  Credentials live only inside the task closure, never in a column
or in the plan text, and are not sent on when a redirect leaves the host.

A fetch has side effects and may be retried by Spark, so results are written
to shared storage once (``fetch_to_staging``) and read back from there, rather
than being recomputed by every action.
"""

from __future__ import annotations

import base64
import email.utils
import functools
import http.client
import itertools
import json
import ssl
import time
import urllib.error
import urllib.parse
import urllib.request
from collections import deque
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .. import session
from . import objects

# Request defaults of the connector's HTTP helper.
CONNECT_TIMEOUT_MS = 1000
READ_TIMEOUT_MS = 5000

BODY_MODES = ("string", "bytes", "file")

#: URL schemes a request table may use; ``file`` reads what executors can see, so it is opt-out by this list
SCHEMES = ("http", "https", "file")
#: no wait between two tries of a request is longer, whatever the endpoint asks
RETRY_WAIT_MAX_S = 300.0


def response_schema(id_type: T.DataType = T.LongType()) -> T.StructType:
    return T.StructType([
        T.StructField("request_id", id_type),
        T.StructField("status", T.IntegerType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("body_text", T.StringType()),
        T.StructField("body_bytes", T.BinaryType()),
        T.StructField("error", T.StringType()),
        T.StructField("attempts", T.IntegerType()),
    ])


REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("body", T.StringType()),
])


def url_of(path: Column) -> Column:
    """``file:///...`` URL for a staged path (``file:/x``, ``/x``), percent-encoded; others unchanged."""
    bare = F.regexp_replace(path, r"^file:(//)?", "")
    quoted = F.replace(F.replace(F.url_encode(bare), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))
    return F.when(path.rlike(r"^(file:|/)"), F.concat(F.lit("file://"), quoted)).otherwise(path)


def build_requests(df: DataFrame, request_id, url, headers=None, body=None,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Shape any frame into the request table (plus the ``keep`` columns).

    ``method`` is POST exactly when the body is non-empty, GET otherwise; an
    empty or null URL is kept and answered with an error row by the fetch.
    """
    col = lambda c: F.col(c) if isinstance(c, str) else c
    body_c = col(body) if body is not None else F.lit(None).cast("string")
    hdr_c = col(headers) if headers is not None else F.lit(None).cast("map<string,string>")
    return df.select(
        col(request_id).alias("request_id"),
        col(url).cast("string").alias("url"),
        F.when(F.length(body_c) > 0, F.lit("POST")).otherwise(F.lit("GET")).alias("method"),
        hdr_c.alias("headers"),
        body_c.alias("body"),
        *keep,
    )


def _auth_header(auth: dict | None) -> str | None:
    if not auth:
        return None
    kind = str(auth.get("type", auth.get("auth_type", ""))).lower()
    if kind == "basic":
        raw = f"{auth.get('username', '')}:{auth.get('password', '')}".encode()
        return "Basic " + base64.b64encode(raw).decode()
    if kind == "client":
        raw = f"{auth.get('client_id', '')}:{auth.get('client_key', '')}".encode()
        return "Basic " + base64.b64encode(raw).decode()
    if kind in ("bearer", "token", "oauth"):
        return f"{auth.get('token_type', 'Bearer')} {auth['token']}"
    raise ValueError(f"unknown auth type {kind!r}")


def _retryable(exc: Exception) -> bool:
    """Trouble on the way and answers that ask to come back; never a wrong URL, a bad certificate or a refusal."""
    if isinstance(exc, urllib.error.HTTPError):
        return exc.code >= 500 or exc.code in (408, 429)
    if isinstance(exc, urllib.error.URLError):
        return not isinstance(exc.reason, ssl.SSLError) and "unknown url type" not in str(exc.reason)
    return isinstance(exc, (OSError, http.client.HTTPException)) and not isinstance(exc, http.client.InvalidURL)


class _Redirects(urllib.request.HTTPRedirectHandler):
    """Redirects without credentials when they lead to another host."""

    def redirect_request(self, req, fp, code, msg, headers, newurl):
        new = super().redirect_request(req, fp, code, msg, headers, newurl)
        if new is not None and urllib.parse.urlsplit(newurl).netloc != urllib.parse.urlsplit(req.full_url).netloc:
            for name in ("Authorization", "Cookie", "Proxy-authorization"):
                new.remove_header(name)
        return new


class _ReadTimeout:
    """Connection mix-in: connect under ``timeout``, then read under ``read_timeout``."""

    def __init__(self, *args, read_timeout=None, **kwargs):
        super().__init__(*args, **kwargs)
        self.read_timeout = read_timeout

    def connect(self):
        super().connect()
        if self.read_timeout is not None:
            self.sock.settimeout(self.read_timeout)


class _HTTPConnection(_ReadTimeout, http.client.HTTPConnection):
    pass


class _HTTPSConnection(_ReadTimeout, http.client.HTTPSConnection):
    pass


def _timed_handlers(read_timeout_s: float):
    class HTTP(urllib.request.HTTPHandler):
        def http_open(self, req):
            return self.do_open(functools.partial(_HTTPConnection, read_timeout=read_timeout_s), req)

    class HTTPS(urllib.request.HTTPSHandler):
        def https_open(self, req):
            return self.do_open(functools.partial(_HTTPSConnection, read_timeout=read_timeout_s), req,
                                context=self._context)

    return [HTTP(), HTTPS()]


def build_opener(proxy_host=None, proxy_port=None, read_timeout_ms=READ_TIMEOUT_MS):
    """urllib opener, routed through ``proxy_host:proxy_port`` when given.

    The per-request ``timeout`` bounds the connect; ``read_timeout_ms`` then
    bounds every socket read (the connector's separate connect/read timeouts).
    """
    handlers = [*_timed_handlers(read_timeout_ms / 1000.0), _Redirects()]
    if proxy_host:
        where = f"{proxy_host}:{proxy_port}" if proxy_port else proxy_host
        handlers.append(urllib.request.ProxyHandler({"http": where, "https": where}))
    return urllib.request.build_opener(*handlers)


def _refresh(auth: dict, send) -> dict | None:
    """New credentials from the refresh token (``refrsh_token`` as the connector spells it), or None."""
    token = auth.get("refresh_token", auth.get("refrsh_token"))
    where = auth.get("token_url")
    if not token or not where:
        return None
    form = {"grant_type": "refresh_token", "refresh_token": token}
    form |= {k: auth[k] for k in ("client_id", "client_key") if k in auth}
    got = json.loads(send(urllib.request.Request(
        where, data=urllib.parse.urlencode(form).encode(), method="POST",
        headers={"Content-Type": "application/x-www-form-urlencoded"})))
    if not got.get("access_token"):
        return None
    return auth | {"type": "bearer", "token": got["access_token"], "token_type": got.get("token_type") or "Bearer",
                   "refresh_token": got.get("refresh_token") or token}


def wait_before_retry(exc: Exception, attempts: int, base_s: float, growth: float, most_s: float) -> float:
    """Seconds until the next try: ``base_s``, growing with each try, or what a ``Retry-After`` asks if that is longer.

    A ``Retry-After`` is seconds or a date; no wait is longer than ``most_s``.
    """
    wait = base_s * growth ** (attempts - 1)
    asked = exc.headers.get("Retry-After") if isinstance(exc, urllib.error.HTTPError) and exc.headers else None
    if asked:
        try:
            wait = max(wait, float(asked))
        except ValueError:
            try:
                wait = max(wait, email.utils.parsedate_to_datetime(asked).timestamp() - time.time())
            except (TypeError, ValueError):  # no date either
                pass
    return max(0.0, min(wait, most_s))


class Pace:
    """Turns to send: those of one key (a host's share) lie at least ``1 / rate`` seconds apart, over all threads of a task."""

    def __init__(self, rate: float):
        import threading

        self.gap, self.next, self.lock = 1.0 / rate, {}, threading.Lock()

    def wait(self, key) -> None:
        with self.lock:
            now = time.monotonic()
            turn = max(now, self.next.get(key, now))
            self.next[key] = turn + self.gap
        if turn > now:
            time.sleep(turn - now)


def _read_up_to(source, n: int) -> bytes:
    """``n`` bytes, fewer only where the source ends."""
    got = b""
    while len(got) < n:
        more = source.read(n - len(got))
        if not more:
            break
        got += more
    return got


def make_fetcher(body_mode="string", on_error="row", connect_timeout_ms=CONNECT_TIMEOUT_MS,
                 read_timeout_ms=READ_TIMEOUT_MS, proxy_host=None, proxy_port=None,
                 auth=None, retry_count=0, retry_frequency_s=1.0, opener=None, schemes=SCHEMES,
                 retry_growth=1.0, retry_wait_max_s=RETRY_WAIT_MAX_S, inline_bytes=0):
    """Return ``fetch_one(url, method, headers, body, target=None, turn=None) -> tuple`` (runs in a task).

    The tuple is (status, headers, text, bytes, error, attempts).  With
    ``body_mode="file"`` the body is streamed to ``target`` in chunks and the
    text slot holds the path; a body of at most ``inline_bytes`` (if above 0) goes to
    the bytes slot instead, and no file is made.  ``auth`` with a refresh token and a ``token_url``
    gets a new token once an answer is 401, for this and later requests.
    ``opener`` replaces urllib's: an object with ``open(request, timeout=..)``,
    or a class made with (proxy host, proxy port, read timeout in ms).
    ``turn`` is called before every try, the retries too.
    """
    mode = (body_mode or "").lower()
    # connect timeout per request; the opener applies the read timeout after connecting
    timeout = connect_timeout_ms / 1000.0
    state = {"auth": dict(auth) if auth else None}
    _auth_header(auth)  # an unknown type fails here, on the driver

    def fetch_one(url, method, headers, body, target=None, turn=None):
        if "opener" not in state:
            make = build_opener if opener is None else opener if isinstance(opener, type) else None
            state["opener"] = make(proxy_host, proxy_port, read_timeout_ms) if make else opener
        op = state["opener"]
        if not url:
            return (None, None, None, None, "empty url: no request made", 0)
        scheme = urllib.parse.urlsplit(url).scheme.lower()
        if scheme not in schemes:
            return (None, None, None, None, f"scheme {scheme!r} is not allowed", 0)
        data = body.encode("utf-8") if body else None
        attempts, renewed, last = 0, False, None
        while attempts <= retry_count + renewed:
            attempts += 1
            if turn is not None:
                turn()
            hdrs = dict(headers or {})
            used = state["auth"]
            value = _auth_header(used)
            if value:
                hdrs["Authorization"] = value
            try:
                req = urllib.request.Request(url, data=data, headers=hdrs,
                                             method=method or ("POST" if data else "GET"))
                with op.open(req, timeout=timeout) as resp:
                    status = getattr(resp, "status", None)
                    rh = {str(k): str(v) for k, v in (resp.headers.items() if resp.headers else [])}
                    text = raw_bytes = None
                    if mode == "file":
                        head = _read_up_to(resp, inline_bytes + 1) if inline_bytes else b""
                        if inline_bytes and len(head) <= inline_bytes:
                            raw_bytes = head
                        else:
                            rest = iter(lambda: resp.read(objects.CHUNK), b"")
                            objects.write_chunks(target, itertools.chain([head] if head else [], rest))
                            text = target
                    elif mode == "string":
                        charset = None
                        if resp.headers is not None and hasattr(resp.headers, "get_content_charset"):
                            charset = resp.headers.get_content_charset()
                        text = resp.read().decode(charset or "utf-8", errors="replace")
                    elif mode == "bytes":
                        raw_bytes = resp.read()
                    else:
                        resp.read()
                return (status, rh, text, raw_bytes, None, attempts)
            except Exception as exc:  # noqa: BLE001 -- error as data
                last = exc
                if used and not renewed and isinstance(exc, urllib.error.HTTPError) and exc.code == 401:
                    if state["auth"] is used:  # another thread may have renewed it meanwhile
                        def send(request):
                            with op.open(request, timeout=timeout) as answer:
                                return answer.read()

                        try:
                            state["auth"] = _refresh(used, send) or used
                        except Exception as no:  # noqa: BLE001
                            last = no
                    renewed = state["auth"] is not used
                    if renewed:
                        continue
                if attempts > retry_count + renewed or not _retryable(exc):
                    break
                time.sleep(wait_before_retry(exc, attempts, retry_frequency_s, retry_growth, retry_wait_max_s))
        if on_error == "fail":
            raise RuntimeError(f"fetch failed for {url}: {last!r}") from last
        status = last.code if isinstance(last, urllib.error.HTTPError) else None
        return (status, None, None, None, f"{type(last).__name__}: {last}", attempts)

    return fetch_one


def in_order(pool, call, rows, ahead: int):
    """``call`` of every row, in order, with at most ``ahead`` under way or waiting."""
    if pool is None:
        yield from map(call, rows)
        return
    under_way = deque()
    for row in rows:
        under_way.append(pool.submit(call, row))
        if len(under_way) >= ahead:
            yield under_way.popleft().result()
    while under_way:
        yield under_way.popleft().result()


def fetch_requests(requests: DataFrame, body_mode: str = "string", on_error: str = "row",
                   connect_timeout_ms: int = CONNECT_TIMEOUT_MS,
                   read_timeout_ms: int = READ_TIMEOUT_MS, proxy_host: str | None = None,
                   proxy_port: int | None = None, auth: dict | None = None,
                   retry_count: int = 0, retry_frequency_s: float = 1.0,
                   parallelism: int | None = None, threads: int = 1,
                   chunk_rows: int = 64, opener=None, keep: tuple[str, ...] = (),
                   per_host: int | None = None, partitions: int | None = None,
                   body_dir: str | None = None, suffix: str = "", schemes=SCHEMES,
                   retry_growth: float = 1.0, retry_wait_max_s: float = RETRY_WAIT_MAX_S, log=None,
                   rate_per_host: float | None = None, inline_bytes: int = 0) -> DataFrame:
    """Fetch every request on the executors; one response row per request (lazy).

    Requests are dealt round-robin over ``partitions`` tasks (``parallelism``
    is its older name); a retried task repeats one share only, so many small
    tasks are cheap to lose.  How many run at once is the cluster's cores times
    ``threads``.  With ``per_host=k`` they are hash-partitioned on (host, salt
    in 0..k-1) instead: at most ``k`` tasks hold any one host's requests, so no
    host sees more than ``k * threads`` concurrent requests, and a host holding
    most of the requests is still split ``k`` ways.
    ``rate_per_host=r`` sends any host at most ``r`` requests a second, retries
    counted, all tasks together: each of its ``per_host`` shares (default 1) is in
    one task and goes at ``r / per_host``, and hosts that share a task take turns.
    It waits only before sending, so a task that starts late never catches up in
    a burst; a lost task's share starts anew at its own pace.
    ``keep`` names request columns carried into the response rows as they are.
    ``body_mode="file"`` streams each body to ``body_dir/<request id><suffix>``
    and returns its path in ``body_text``; no body is held in memory.  With
    ``inline_bytes=n`` bodies of at most ``n`` bytes are returned in ``body_bytes``
    and make no file: millions of small files are slow to list, plan and open.
    ``log`` is called in the task with every batch of responses before any of
    them is passed on.
    """
    if on_error not in ("row", "fail"):
        raise ValueError("on_error must be 'row' or 'fail'")
    if rate_per_host is not None:
        if rate_per_host <= 0:
            raise ValueError("rate_per_host must be above 0")
        per_host = per_host or 1
    spark = requests.sparkSession
    fetch_one = make_fetcher(body_mode, on_error, connect_timeout_ms, read_timeout_ms, proxy_host, proxy_port,
                             auth, retry_count, retry_frequency_s, opener, schemes, retry_growth, retry_wait_max_s, inline_bytes)
    base = response_schema(requests.schema["request_id"].dataType)
    schema = T.StructType(base.fields[:1] + [requests.schema[c] for c in keep] + base.fields[1:])
    if body_mode == "file":
        if body_dir is None:
            raise ValueError("body_mode='file' needs body_dir")
        body_dir = session.qualify(spark, body_dir)
        objects._raise_on_repeats(requests, "request_id")
        if not requests.where("request_id IS NULL").isEmpty():
            # numbered once and written, so that a retried task finds the same names; no id's name begins with %n
            where = f"{session.new_staging_dir(spark, 'requests')}/numbered"
            requests = objects.materialise(requests.withColumn(
                "_lading_file", F.when(F.col("request_id").isNull(), F.concat(F.lit("%null-"), F.monotonically_increasing_id()))), where)

    wanted = ["request_id", "url", "method", "headers", "body"]
    # a bare (request_id, url) table is a table of GETs
    defaults = {"body": F.lit(None).cast("string"),
                "headers": F.lit(None).cast("map<string,string>")}
    for c, v in defaults.items():
        if c not in requests.columns:
            requests = requests.withColumn(c, v)
    if "method" not in requests.columns:
        requests = requests.withColumn(
            "method", F.when(F.length("body") > 0, F.lit("POST")).otherwise(F.lit("GET")))
    # ids and kept columns pass as they are; a name for the file is made in the JVM
    rows = requests.select("request_id", *keep, F.col("url").alias("_url"), F.col("method").alias("_method"),
                           F.col("headers").alias("_headers"), F.col("body").alias("_body"),
                           F.col("request_id").cast("string").alias("_name") if body_mode == "file"
                           else F.lit(None).cast("string").alias("_name"),
                           (F.col("_lading_file") if "_lading_file" in requests.columns else F.lit(None).cast("string")).alias("_unnamed"),
                           F.lit(None).cast("string").alias("_share"))

    def run(batches):
        import pyarrow as pa

        pool = ThreadPoolExecutor(threads) if threads > 1 else None
        pace = Pace(rate_per_host / per_host) if rate_per_host else None

        def call(row):
            url, method, headers, body, name, unnamed, share = row
            target = None if body_dir is None else f"{body_dir}/{unnamed or objects.object_name(name)}{suffix}"
            turn = None if pace is None else functools.partial(pace.wait, share)
            return fetch_one(url, method, dict(headers) if headers else None, body, target, turn)

        kinds = (pa.int32(), pa.map_(pa.string(), pa.string()), pa.string(), pa.binary(), pa.string(), pa.int32())

        def batch(part, results):
            columns = list(zip(*results))
            columns[1] = [None if h is None else list(h.items()) for h in columns[1]]
            return pa.RecordBatch.from_arrays([*part.columns[:1 + len(keep)], *(pa.array(c, k) for c, k in zip(columns, kinds))],
                                              names=[f.name for f in schema.fields])

        try:
            for b in batches:
                asked = zip(*(c.to_pylist() for c in b.columns[1 + len(keep):]))
                answers = in_order(pool, call, asked, max(2 * threads, chunk_rows if pool else 1))
                # small output chunks keep at most chunk_rows bodies in memory
                for start in range(0, b.num_rows, chunk_rows):
                    part = b.slice(start, chunk_rows)
                    answered = batch(part, [next(answers) for _ in range(part.num_rows)])
                    if log:
                        log(answered)
                    yield answered
        finally:
            if pool:
                pool.shutdown()

    n = partitions or parallelism or spark.sparkContext.defaultParallelism
    if per_host:
        host = F.lower(F.regexp_extract("_url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
        salt = F.pmod(F.xxhash64(F.col("request_id").cast("string"), "_url"), F.lit(per_host))
        if rate_per_host:
            # every share whole in one task, its requests numbered there; by number, so that hosts take turns
            share = F.concat_ws(" ", salt.cast("string"), host)
            rows = (rows.withColumn("_share", share).repartition(n, "_share")
                    .withColumn("_rank", F.row_number().over(Window.partitionBy("_share").orderBy("request_id", "_url")))
                    .sortWithinPartitions("_rank").drop("_rank"))
        else:
            rows = rows.repartition(n, host, salt)
    else:
        # round-robin: even request counts per task whatever the ids look like
        # (deterministic on retry: Spark sorts rows locally before a round-robin split)
        rows = rows.repartition(n)
    return rows.mapInArrow(run, schema)


def fetch_to_staging(requests: DataFrame, staging_dir: str | None = None, **fetch_options) -> DataFrame:
    """Fetch once, persist the responses to shared storage, return them from there."""
    spark = requests.sparkSession
    where = staging_dir or session.new_staging_dir(spark, "fetch")
    return objects.materialise(fetch_requests(requests, **fetch_options), f"{where}/responses")


def responses_to_files(responses: DataFrame, dest_dir: str, body: str = "body_text",
                       suffix: str = "", parallelism: int | None = None) -> DataFrame:
    """Save each response body as one file named after its request id.

    Returns the materialised manifest ``(request_id, staged_path, length, error)``
    with a row for every response: failed fetches and failed saves have
    ``error`` set and no file.
    """
    whole = responses.select("request_id", F.when(F.col("error").isNull(), F.col(body)).alias("_body"),
                             F.col("error").alias("_failed"))
    saved = objects.write_objects(whole, "request_id", "_body", dest_dir, suffix, parallelism, keep=("_failed",))
    manifest = saved.select("request_id", "staged_path", "length", F.coalesce("_failed", "error").alias("error"))
    return objects.materialise(manifest, f"{dest_dir.rstrip('/')}/_manifest")
