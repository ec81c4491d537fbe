"""One huge xml or quoted csv file read by many tasks: byte ranges that meet at records.

Spark reads such files whole, since a byte alone does not say whether it stands
inside a quoted field, a comment, a CDATA section or another record.  Here a file
is cut into byte ranges, one row each.  A first pass reduces every range to what
it does to that state; running over a file's ranges in order (small rows) gives
the state each begins in.  The second pass cuts the records that begin in a
range, reading on past its end for the last one, and the JVM parses them
(``from_xml``, ``from_csv``).  Files of one range need no first pass.

Xml: a record belongs to the range its start tag begins in; elements of the
same name inside a record are part of it.  Text and comments around records are
skipped.  Csv: quotes are written as two quotes (``escape='"'``) and fields that
hold quotes are quoted; each file's header line is dropped.  Files are UTF-8 and
tasks can open them (``objects.streamable``); a schema is needed.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import session
from . import formats

RANGE_BYTES = 32 << 20
#: what is read past a range's end at first; doubled while the last record is open
TAIL = 1 << 16
#: tasks of a scan; beyond, a task takes several ranges
MOST_TASKS = 100_000

NORMAL, COMMENT, CDATA = 0, 1, 2


def file_ranges(spark: SparkSession, path, range_bytes: int) -> tuple[DataFrame, int]:
    """``path, size, number, ranges`` of every byte range, spread over tasks, and over how many."""
    from ..operators import objects

    paths = [session.qualify(spark, p) for p in ([path] if isinstance(path, str) else path)]
    if not objects.streamable(paths):
        raise ValueError(f"tasks cannot open {paths}; stage them first")
    files = objects.listing(spark, paths).select("path", F.col("length").alias("size"))
    ranges = F.ceil(F.col("size") / range_bytes).cast("long")
    rows = files.where("size > 0").withColumn("ranges", ranges)
    tasks = min(rows.agg(F.sum("ranges")).first()[0] or 1, MOST_TASKS)
    return rows.withColumn("number", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ranges") - 1))).repartition(tasks), tasks


class Window:
    """Bytes of a file from ``begin`` on, grown as they are asked for."""

    def __init__(self, path: str, begin: int, end: int, size: int):
        from ..operators import objects

        fs, where = objects.arrow_location(path)
        self.source, self.begin, self.size = fs.open_input_file(where), begin, size
        if self.source.size() != size:
            raise OSError(f"{path} changed while it was read")
        self.data = b""
        self.until(end)

    def until(self, end: int) -> None:
        have, end = self.begin + len(self.data), min(end, self.size)
        if end > have:
            self.source.seek(have)
            self.data += self.source.read(end - have)

    @property
    def whole(self) -> bool:
        return self.begin + len(self.data) >= self.size


# --- xml ------------------------------------------------------------------------

def _tokens(tag: str):
    return re.compile(rb"<!--|-->|<!\[CDATA\[|\]\]>|<(/?)" + re.escape(tag.encode()) + rb"(?=[\s/>])")


#: the rest of a tag after its name: quoted values may hold a >
_TAG_REST = re.compile(rb"""(?:[^"'>]|"[^"]*"|'[^']*')*>""")


def _steps(view: Window, token, begin: int, end: int):
    """(place, kind, end) of tokens: openers and tags that begin in the range, closers that end in it.

    ``end`` is where a tag ends (its > included), None if the window has no more of it.
    """
    for m in token.finditer(view.data):
        text, at = m.group(), view.begin + m.start()
        if text in (b"-->", b"]]>"):
            if begin < at + 3 <= end:
                yield at, text, at + 3
        elif begin <= at < end:
            if text in (b"<!--", b"<![CDATA["):
                yield at, text, at + len(text)
                continue
            rest = _TAG_REST.match(view.data, m.end())
            kind = b"</" if m.group(1) else b"</>" if rest and rest.group().endswith(b"/>") else b"<"
            yield at, kind, view.begin + rest.end() if rest else None


def _next_mode(mode: int, kind: bytes) -> int:
    if mode == NORMAL:
        return COMMENT if kind == b"<!--" else CDATA if kind == b"<![CDATA[" else NORMAL
    return NORMAL if kind == (b"-->" if mode == COMMENT else b"]]>") else mode


def _xml_effect(tag: str, range_bytes: int):
    """What each range does: for every mode it may begin in, the mode and the change of depth it ends with."""
    token = _tokens(tag)

    def effect(path, number, size):
        begin, end = number * range_bytes, min((number + 1) * range_bytes, size)
        view, tail = Window(path, max(0, begin - 2), end + TAIL, size), TAIL
        while True:
            steps = list(_steps(view, token, begin, end))
            if all(stop is not None for _, _, stop in steps) or view.whole:
                break
            tail *= 2
            view.until(end + tail)
        out = []
        for mode in (NORMAL, COMMENT, CDATA):
            depth = 0
            for _, kind, _ in steps:
                if mode == NORMAL:
                    depth += (kind == b"<") - (kind == b"</")
                mode = _next_mode(mode, kind)
            out += [mode, depth]
        return out

    return effect


def _xml_records(tag: str, range_bytes: int):
    """The records whose start tag begins in a range, given the mode and depth the range begins in."""
    token = _tokens(tag)

    def records(path, number, size, mode, depth):
        begin, end = number * range_bytes, min((number + 1) * range_bytes, size)
        view, tail = Window(path, max(0, begin - 2), end + TAIL, size), TAIL
        while True:
            found, m, d, start = [], mode, depth, None
            for at, kind, stop in _steps(view, token, begin, size):
                if at >= end and start is None:
                    break
                if m == NORMAL and stop is not None:
                    if kind == b"</>" and d == 0:
                        found.append((at, stop))
                    elif kind == b"<":
                        if d == 0:
                            start = at
                        d += 1
                    elif kind == b"</":
                        d -= 1
                        if d == 0 and start is not None:
                            found.append((start, stop))
                            start = None
                elif m == NORMAL and stop is None and at < end:
                    start = at if start is None else start  # the tag itself is not whole yet
                m = _next_mode(m, kind)
            if start is None or view.whole:
                break
            tail *= 2
            view.until(end + tail)
        return [view.data[a - view.begin:b - view.begin].decode("utf-8") for a, b in found]

    return records


def _xml_states(rows):
    """A file's ranges in order: the mode and depth that each begins in."""
    import pandas as pd

    rows = rows.sort_values("number")
    mode, depth, states = NORMAL, 0, []
    for effect in rows["effect"]:
        states.append((mode, depth))
        mode, depth = int(effect[2 * mode]), depth + int(effect[2 * mode + 1])
    return pd.DataFrame({"path": rows["path"], "size": rows["size"], "number": rows["number"],
                         "mode": [s[0] for s in states], "depth": [s[1] for s in states]})


def _mapped(rows: DataFrame, columns: list[str], call, schema: str, each: bool) -> DataFrame:
    """``call(*columns)`` per row: one list of values (``each`` false), or one output row per value."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            names = batch.schema.names
            for k, row in enumerate(zip(*(batch.column(c).to_pylist() for c in columns))):
                got = call(*row)
                if each:
                    yield pa.RecordBatch.from_arrays([pa.array(got, pa.string())], names=["record"])
                else:
                    yield pa.RecordBatch.from_arrays([*(c.slice(k, 1) for c in batch.columns), pa.array([got], pa.list_(pa.int64()))],
                                                     names=[*names, "effect"])

    return rows.mapInArrow(run, schema)


def xml_records(spark: SparkSession, path, row_tag: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``record``: the text of every ``row_tag`` element that is not inside another one."""
    ranges, tasks = file_ranges(spark, path, range_bytes)
    state = F.lit(0).cast("long")
    alone = ranges.where("ranges = 1").select("path", "size", "number", state.alias("mode"), state.alias("depth"))
    effects = _mapped(ranges.where("ranges > 1").select("path", "size", "number"), ["path", "number", "size"],
                      _xml_effect(row_tag, range_bytes), "path string, size long, number long, effect array<bigint>", False)
    states = effects.groupBy("path").applyInPandas(_xml_states, "path string, size long, number long, mode long, depth long")
    placed = alone.union(states)
    spread = placed.repartition(tasks, "path", "number")
    return _mapped(spread, ["path", "number", "size", "mode", "depth"], _xml_records(row_tag, range_bytes), "record string", True)


def read_xml_ranges(spark: SparkSession, path, schema, row_tag: str, range_bytes: int = RANGE_BYTES, **options) -> DataFrame:
    """The rows of xml files, however large each is; reader options as for ``fileType`` xml."""
    opts = formats.read_options("xml", formats.normalise(options | {"rowTag": row_tag}))
    _utf8(opts)
    records = xml_records(spark, path, row_tag, range_bytes)
    wanted = {k: v for k, v in opts.items() if k.lower() not in ("encoding", "charset")}
    return records.select(F.from_xml("record", _struct(schema), wanted).alias("r")).select("r.*")


def _struct(schema) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)


def _utf8(options: dict) -> None:
    charset = formats.get(options, "encoding") or formats.get(options, "charset") or "UTF-8"
    if charset.upper().replace("-", "") != "UTF8":
        raise ValueError(f"byte ranges are cut in UTF-8, not {charset}")


# --- csv ------------------------------------------------------------------------

def _csv_effect(range_bytes: int, quote: int):
    def effect(path, number, size):
        import numpy as np

        begin, end = number * range_bytes, min((number + 1) * range_bytes, size)
        data = np.frombuffer(Window(path, begin, end, size).data, np.uint8)
        return [int((data == quote).sum()) & 1]

    return effect


def _csv_records(range_bytes: int, quote: int, header: bool):
    """The records that begin in a range: ``odd`` tells whether it begins inside quotes."""
    def records(path, number, size, odd):
        import numpy as np

        begin, end = number * range_bytes, min((number + 1) * range_bytes, size)
        view, tail = Window(path, begin, end + TAIL, size), TAIL
        while True:
            data = np.frombuffer(view.data, np.uint8)
            inside = (np.cumsum(data == quote) + odd) & 1
            feeds = np.flatnonzero((data == 10) & (inside == 0)) + 1  # records end here, others begin
            last = feeds[feeds >= end - begin]
            if len(last) or view.whole:
                break
            tail *= 2
            view.until(end + tail)
        # the byte before the range tells whether one begins with it
        first = begin == 0
        if not first and not odd:
            first = Window(path, begin - 1, begin, size).data == b"\n"
        starts = np.concatenate([[0] if first else [], feeds[feeds < end - begin]]).astype(np.int64)
        stops = np.append(starts[1:], last[0] if len(last) else len(data)) if len(starts) else starts
        out = [view.data[a:b].decode("utf-8").rstrip("\r\n") for a, b in zip(starts.tolist(), stops.tolist())]
        return [r for r in (out[1:] if header and begin == 0 else out) if r.strip()]

    return records


def read_csv_ranges(spark: SparkSession, path, schema, range_bytes: int = RANGE_BYTES, **options) -> DataFrame:
    """The rows of csv files whose quoted fields may hold line feeds, however large each file is."""
    opts = formats.read_options("csv", formats.normalise(options))
    _utf8(opts)
    quote = formats.get(opts, "quote", '"')
    if formats.get(opts, "escape", "\\") != quote or len(quote.encode()) != 1:
        raise ValueError("ranges of csv need quotes that are written as two: escape must be the quote")
    ranges, tasks = file_ranges(spark, path, range_bytes)
    alone = ranges.where("ranges = 1").select("path", "size", "number", F.lit(0).cast("long").alias("odd"))
    several = ranges.where("ranges > 1").select("path", "size", "number")
    counted = _mapped(several, ["path", "number", "size"], _csv_effect(range_bytes, ord(quote)),
                      "path string, size long, number long, effect array<bigint>", False)
    before = F.expr("sum(effect[0]) OVER (PARTITION BY path ORDER BY number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    placed = alone.union(counted.select("path", "size", "number", (F.coalesce(before, F.lit(0)) % 2).cast("long").alias("odd")))
    spread = placed.repartition(tasks, "path", "number")
    records = _mapped(spread, ["path", "number", "size", "odd"],
                      _csv_records(range_bytes, ord(quote), formats.flag(opts, "header")), "record string", True)
    wanted = {k: v for k, v in opts.items() if k.lower() not in ("header", "inferschema", "encoding", "charset")} | {"multiLine": "true"}
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in _struct(schema).fields)
    return records.select(F.from_csv("record", ddl, wanted).alias("r")).select("r.*")
