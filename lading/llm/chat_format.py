"""Chat formatting: heterogeneous records to canonical turns, and turns to marked text.

A record's nested field paths (``messages[].role``), restricted to the fields
some layout names, are hashed; the hash selects a declarative mapping that says
where its turns are.  Optional fields give a layout several hashes, so selection
is one dictionary look-up.  Every turn becomes one formatted row; a
conversation's text is its rows in order.  Working by turn keeps memory bounded
whatever one conversation holds.

The template is ``<turn role="ROLE">``, a line feed, the text, ``</turn>`` and a
line feed.  Inside texts and roles a control string gets one backslash after its
``<`` (and any backslashes already there), which reading takes away again; a
role's ``">`` is broken the same way.  So every text round-trips, and markers
only occur where the template put them.

Defined cases: null roles and texts are empty; a record without a known layout,
or that is not a JSON object, nested too deep, with a message that is no object
or a turn that is no 64-bit whole number gives one row with ``layout`` null and
no turn; half a surrogate pair in an escape becomes U+FFFD;
fields that no layout names are ignored; turns of one conversation are ordered
by turn number (null first), role and text, repeated rows all count; a null
conversation id is a conversation; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONE = re.compile("[\ud800-\udfff]")


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns.

    ``parts`` are (role, field) pairs of single turns in order, fields with the
    same role as their predecessor being joined to it; or ``items`` names a
    list of messages with a role and a text field.  ``conv``, ``turn`` and
    ``role`` are fields of layouts with one turn in a record.
    """

    name: str
    parts: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    items: str | None = None
    role: str | None = None
    text: str | None = None
    conv: str | None = None
    turn: str | None = None
    roles: dict = field(default_factory=dict)

    def paths(self) -> list[str]:
        if self.items:
            return [f"{self.items}[].{self.role}", f"{self.items}[].{self.text}"]
        if self.role:
            return [self.conv, self.turn, self.role, self.text]
        return [path for _, path in self.parts] + [p for p in self.optional if p not in dict(map(reversed, self.parts))]


MAPPINGS = (
    Mapping("turn_rows", conv="conv_id", turn="turn", role="role", text="text"),
    Mapping("messages", items="messages", role="role", text="content"),
    Mapping("dialogue", items="conversations", role="from", text="value",
            roles={"human": "user", "gpt": "assistant"}),
    Mapping("instruction", parts=(("user", "instruction"), ("user", "input"), ("assistant", "output")),
            optional=("input",)),
    Mapping("prompt_response", parts=(("system", "system"), ("user", "prompt"), ("assistant", "response")),
            optional=("system",)),
    Mapping("prompt_completion", parts=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("question_answer", parts=(("user", "context"), ("user", "question"), ("assistant", "answer")),
            optional=("context",)),
)


def field_paths(value, prefix: str = "") -> set[str]:
    """The nested field paths of a parsed JSON value; lists add ``[]``."""
    if isinstance(value, dict):
        if not value:
            return {prefix} if prefix else set()
        return set().union(*(field_paths(v, f"{prefix}.{k}" if prefix else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union({f"{prefix}[]"} if not value else set(), *(field_paths(v, f"{prefix}[]") for v in value))
    return {prefix}


def fingerprint(paths) -> str:
    return hashlib.blake2b("\n".join(sorted(paths)).encode(), digest_size=8).hexdigest()


def registry(mappings=MAPPINGS) -> tuple[set[str], dict[str, Mapping]]:
    """All fields that layouts name, and the mapping of each fingerprint."""
    known, by_hash = set(), {}
    for m in mappings:
        paths = set(m.paths())
        known |= paths
        # an empty list of messages is the same layout
        empty = [{f"{m.items}[]"}] if m.items else []
        known.update(*empty)
        for n in range(len(m.optional) + 1):
            for gone in combinations(m.optional, n):
                by_hash.setdefault(fingerprint(paths - set(gone)), m)
        for only in empty:
            by_hash.setdefault(fingerprint(only), m)
    return known, by_hash


class Unfit(ValueError):
    """A record that has a layout's fields, but not values that make turns."""


def _string(value) -> str:
    """A value as text; half a surrogate pair is no character and becomes U+FFFD."""
    if value is None:
        return ""
    text = value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    return LONE.sub("\ufffd", text)


def _turn_number(value):
    if value is None:
        return None
    if isinstance(value, float) and value.is_integer():
        value = int(value)
    if isinstance(value, bool) or not isinstance(value, int) or not -2 ** 63 <= value < 2 ** 63:
        raise Unfit(f"turn {value!r}")
    return value


def turns_of(record, mapping: Mapping) -> list[tuple]:
    """(conv, turn, role, text) rows of one record under its mapping."""
    if mapping.role and not mapping.items:
        conv = record.get(mapping.conv)
        return [(None if conv is None else LONE.sub("\ufffd", str(conv)), _turn_number(record.get(mapping.turn)),
                 _string(record[mapping.role]), _string(record[mapping.text]))]
    if mapping.items:
        if not all(isinstance(m, dict) for m in record[mapping.items]):
            raise Unfit("a message is no object")
        found = [(_string(m.get(mapping.role)), _string(m.get(mapping.text))) for m in record[mapping.items]]
        return [(None, i, mapping.roles.get(r, r), t) for i, (r, t) in enumerate(found)]
    turns: list[list[str]] = []
    for role, path in mapping.parts:
        if path in record and (record[path] or path not in mapping.optional):
            if turns and turns[-1][0] == role:
                turns[-1][1] += "\n" + _string(record[path])
            else:
                turns.append([role, _string(record[path])])
    return [(None, i, role, text) for i, (role, text) in enumerate(turns)]


def rows_of(record_id, raw, known: set[str], by_hash: dict[str, Mapping]) -> list[tuple]:
    """A record's rows; one without a layout if it has none, or is not what its layout needs."""
    mark = None
    try:
        record = json.loads(raw) if raw is not None else None
        if isinstance(record, dict):
            mark = fingerprint(field_paths(record) & known)
            if mapping := by_hash.get(mark):
                return [(record_id if conv is None and not mapping.conv else conv, mark, mapping.name, turn, role, text)
                        for conv, turn, role, text in turns_of(record, mapping)]
    except (ValueError, RecursionError):  # no JSON, unfit, or nested too deep
        pass
    return [(record_id, mark, None, None, None, None)]


def _turn_partition(mappings):
    def run(batches):
        import pyarrow as pa

        known, by_hash = registry(mappings)
        for b in batches:
            rows = [row for record_id, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                    for row in rows_of(record_id, raw, known, by_hash)]
            columns = list(zip(*rows)) if rows else [[]] * 6
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["conv", "fingerprint", "layout", "turn", "role", "text"])

    return run


def as_records(df: DataFrame) -> DataFrame:
    """Rows of any schema as ``record_id`` null and their JSON ``record``, nulls kept."""
    return df.select(F.lit(None).cast("string").alias("record_id"),
                     F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias("record"))


def canonical_turns(records: DataFrame, mappings=MAPPINGS) -> DataFrame:
    """``conv, fingerprint, layout, turn, role, text`` from ``record_id, record`` (JSON text)."""
    return (records.select(F.col("record_id").cast("string"), F.col("record").cast("string"))
            .mapInArrow(_turn_partition(mappings),
                        "conv string, fingerprint string, layout string, turn long, role string, text string"))


def _guard(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)(/?turn)", r"<\\$1$2")


def _unguard(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)(/?turn)", r"<$1$2")


def format_turns(turns: DataFrame, learn_from: str = "assistant") -> DataFrame:
    """``turns`` plus ``formatted``, and the loss mask as ``loss_start, loss_len`` code points in it."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    shown = F.regexp_replace(_guard(role), r'"(\\*)>', r'"\\$1>')
    head = F.concat(F.lit('<turn role="'), shown, F.lit('">\n'))
    body = _guard(text)
    return (turns.drop("formatted", "loss_start", "loss_len")
            .withColumn("formatted", F.concat(head, body, F.lit("</turn>\n")))
            .withColumn("loss_start", F.char_length(head))
            .withColumn("loss_len", F.when(role == learn_from, F.char_length(body)).otherwise(F.lit(0))))


def read_turns(formatted: DataFrame) -> DataFrame:
    """``conv, turn, role, text, loss, formatted_chars`` read from the formatted rows alone.

    ``loss`` is the unescaped text under the mask, null where nothing is masked.
    """
    shape = r'(?s)\A<turn role="(.*?)">\n(.*)</turn>\n\z'
    role = _unguard(F.regexp_replace(F.regexp_extract("formatted", shape, 1), r'"\\(\\*)>', r'"$1>'))
    text = _unguard(F.regexp_extract("formatted", shape, 2))
    masked = F.expr("substring(formatted, loss_start + 1, loss_len)")
    return formatted.select("conv", "turn", role.alias("role"), text.alias("text"),
                            F.when(F.col("loss_len") > 0, _unguard(masked)).alias("loss"),
                            F.char_length("formatted").cast("long").alias("formatted_chars"))


def _digest_partition(batches):
    import pyarrow as pa

    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
    open_, done = None, []
    for b in batches:
        for conv, role, text, loss, chars in zip(*(b.column(n).to_pylist() for n in ("conv", "role", "text", "loss", "formatted_chars"))):
            if open_ is None or open_[0] != conv:
                if open_:
                    done.append(open_)
                open_ = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            open_[1] += 1
            open_[2].update(f"{role}\n{text}\n".encode())
            open_[3] += len(loss or "")
            open_[4].update((loss or "").encode())
            open_[5] += chars
        if done:
            yield batch([(c, n, a.hexdigest(), k, d.hexdigest(), f) for c, n, a, k, d, f in done])
            done = []
    if open_:
        c, n, a, k, d, f = open_
        yield batch([(c, n, a.hexdigest(), k, d.hexdigest(), f)])


def conversation_digests(turns: DataFrame) -> DataFrame:
    """Per conversation: turns, loss and their SHA-256, from ``read_turns`` rows.

    SHA-256 goes through a conversation's bytes in order, so its rows meet in
    one task; they stream through it sorted, and only the digest is held.
    """
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text"]
    return (turns.repartition("conv").sortWithinPartitions(*order)
            .mapInArrow(_digest_partition, "conv string, n_turns long, turns_sha256 string, loss_chars long, "
                                           "loss_sha256 string, formatted_chars long"))
