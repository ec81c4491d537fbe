"""Vector code compression: product codes by member-resident Lloyd rounds, in whole numbers.

A vector is cut into equal parts, and each part position has a codebook of a few
entries.  The members of an entry live with its owners: rows keyed by (position,
entry, salt), each with some thousand members' ids and components.  A round's
new codebook is the sum, over owners, of what their resident members add up to.
Then every owner compares its members with the new entries.  Those that stay
are written where they are; only parts that change entry go through the next
shuffle, to an owner of their new entry.  Each round is written to the shared
staging folder, so a lost executor costs a re-read; a round's files go when the
round after it is written.

The salt spreads an entry that holds any share of all parts over owners of
``RESIDENT`` members on average.  The driver sees the codebook only, whose size
the parameters give.

Distances are exact: as doubles while they stay below 2^53, else as 64-bit
integers; components whose squared distances could leave 64 bits raise.

Defined cases: a vector that is null or holds null or non-finite components is
dropped; vectors shorter than the longest one, or than a multiple of the number
of parts, count as if zeros followed; a null vec_id stays null and comes last
where ids are compared; rows that repeat a vec_id are vectors of their own; with
fewer rows than entries the codebook is that short; an empty table gives no
rows; columns other than ``vec_id``, ``embedding`` and ``label`` are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lading import session
from lading.llm.common import same, small, spark_of

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: members an owner holds on average when one entry has them all
RESIDENT = 32_768
#: members that are compared with a codebook at once
BATCH = 8192

STATE = "part int, entry int, salt int, moved boolean, n long, members binary, components binary, sums array<bigint>"


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest row of ``book`` (the lowest of equals) and the squared distance, for each row of ``x``."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    bound = 4 * x.shape[1] * most * most
    if bound >= 2 ** 62:
        raise OverflowError(f"components of up to {most}: their squared distances leave 64 bits")
    kind = np.float64 if bound < 2 ** 53 else np.int64
    x, book = x.astype(kind), book.astype(kind)
    d = np.stack([((x - entry) ** 2).sum(axis=1) for entry in book], axis=1)
    best = d.argmin(axis=1)
    return best, d[np.arange(len(d)), best].astype(np.int64)


def _chunks(part: int, entry: np.ndarray, salt: np.ndarray, members: np.ndarray, x: np.ndarray, moved: bool):
    """State rows of members by entry and salt."""
    order = np.lexsort((salt, entry))
    at = np.flatnonzero(np.diff(entry[order], prepend=-1).astype(bool) | np.diff(salt[order], prepend=-1).astype(bool))
    for a, b in zip(at, np.append(at[1:], len(order))):
        one = order[a:b]
        yield (part, int(entry[one[0]]), int(salt[one[0]]), moved, len(one), members[one].astype("<i8").tobytes(),
               x[one].astype("<i4").tobytes(), x[one].sum(axis=0, dtype=np.int64).tolist())


def _state_batch(rows: list):
    import pyarrow as pa

    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
    names = [c.strip().split(" ")[0] for c in STATE.split(",")]
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _place_partition(books: np.ndarray, width: int, salts: int):
    """Parts of whole vectors, to the owners of their nearest entries."""
    parts = len(books)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                some = batch.slice(at, BATCH)
                members = some.column(0).to_numpy()
                x = np.zeros((len(members), parts * width), np.int64)
                ends = some.column(1)
                sizes = np.diff(ends.offsets.to_numpy())
                x[np.arange(x.shape[1]) < sizes[:, None]] = ends.flatten().to_numpy()
                for part in range(parts):
                    mine = x[:, part * width:(part + 1) * width]
                    entry, _ = nearest(mine, books[part])
                    yield _state_batch(list(_chunks(part, entry, members % salts, members, mine, True)))

    return run


def _owners(batches, width: int):
    """(part, entry, salt, members, components) of owners: neighbouring rows of one owner are put together."""
    held, key, n = [], None, 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("part", "entry", "salt", "members", "components"))):
            if held and (row[:3] != key or n >= RESIDENT):
                yield *key, *(np.concatenate(c) for c in zip(*held))
                held, n = [], 0
            key = row[:3]
            held.append((np.frombuffer(row[3], "<i8"), np.frombuffer(row[4], "<i4").reshape(-1, width)))
            n += len(held[-1][0])
    if held:
        yield *key, *(np.concatenate(c) for c in zip(*held))


def _round_partition(books: np.ndarray):
    """Owners compare their members with new entries: those that stay, and those that move."""
    def run(batches):
        for part, entry, salt, members, x in _owners(batches, books.shape[2]):
            best = np.concatenate([nearest(x[at:at + BATCH], books[part])[0] for at in range(0, len(x), BATCH)])
            out = []
            for moved in (False, True):
                one = np.flatnonzero((best != entry) == moved)
                if len(one):
                    out += _chunks(part, best[one], np.full(len(one), salt), members[one], x[one], moved)
            yield _state_batch(out)

    return run


def _code_partition(books: np.ndarray):
    """``member, part, entry, distance`` of every resident member."""
    def run(batches):
        import pyarrow as pa

        for part, entry, _, members, x in _owners(batches, books.shape[2]):
            for at in range(0, len(x), BATCH):
                best, d = nearest(x[at:at + BATCH], books[part])
                yield pa.RecordBatch.from_arrays([
                    pa.array(members[at:at + BATCH]), pa.array(np.full(len(best), part, np.int32)),
                    pa.array(best.astype(np.int32)), pa.array(d)], names=["member", "part", "entry", "distance"])

    return run


class _Rounds:
    """The state's tables: each is written, and the one before it is then deleted."""

    def __init__(self, spark):
        self.spark, self.path = spark, None

    def write(self, state: DataFrame) -> DataFrame:
        path = session.new_staging_dir(self.spark, "llm-residents")
        state.write.parquet(path, compression="zstd")
        if self.path:
            session.delete(self.spark, self.path)
        self.path = path
        return self.spark.read.schema(STATE).parquet(path)


def _settled(state: DataFrame) -> DataFrame:
    """Residents where they are, movers at their new owners."""
    owner = ["part", "entry", "salt"]
    return state.where("NOT moved").union(state.where("moved").repartition(*owner).sortWithinPartitions(*owner))


def _updated(books: np.ndarray, state: DataFrame) -> np.ndarray:
    """Entries replaced by the floored mean of their members; unused ones stay."""
    width = books.shape[2]
    sums = state.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(width)))
    out = books.copy()
    for row in sums.collect():  # at most one row per entry of a codebook
        out[row.part, row.entry] = [row[f"s{j}"] // row.n for j in range(width)]
    return out


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, x`` of the vectors that are kept, as integers."""
    real = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return (vectors.where(real)
            .select(F.col("vec_id").cast("long").alias("vec_id"), "label",
                    F.transform("embedding", lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("x")))


def codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
          scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` per kept vector, and the final codebooks (part, entry, component).

    ``code`` has two hex digits per part, so a codebook has at most 256 entries.
    """
    spark = spark_of(vectors)
    if not 1 <= entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    kept_at = session.new_staging_dir(spark, "llm-vectors")
    numbered = integers(vectors, scale).withColumn("member", F.monotonically_increasing_id())
    numbered.write.parquet(kept_at)
    kept = spark.read.schema(numbered.schema).parquet(kept_at)
    n, longest = kept.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    width = max(-(-(longest or 0) // parts), 1)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "x", "member").select("x").limit(entries).collect()
    books = np.zeros((parts, len(first), width), np.int64)
    for e, row in enumerate(first):
        books[:, e] = np.pad(np.array(row.x, np.int64), (0, parts * width - len(row.x))).reshape(parts, width)
    if not n:
        return kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), books

    tables, salts = _Rounds(spark), -(-n // RESIDENT)
    state = tables.write(kept.select("member", "x").mapInArrow(_place_partition(books, width, salts), STATE))
    for at in range(rounds):
        books = _updated(books, state)
        if at < rounds - 1:
            state = tables.write(_settled(state).mapInArrow(_round_partition(books), STATE))
    found = _settled(state).mapInArrow(_code_partition(books), "member long, part int, entry int, distance long")
    digits = [F.lpad(F.lower(F.hex(F.max(F.when(F.col("part") == p, F.col("entry"))))), 2, "0") for p in range(parts)]
    coded = found.groupBy("member").agg(F.concat(*digits).alias("code"), F.sum("distance").alias("error"))
    done = kept.select("vec_id", "label", "member").join(coded, "member").drop("member")
    out = session.new_staging_dir(spark, "llm-codes")
    done.write.parquet(out)
    session.delete(spark, tables.path)
    return spark.read.schema(done.schema).parquet(out), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """``label_error``: the errors of all rows of a label summed, nulls together."""
    totals = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(small(totals), same(F.col("label"), F.col("_label"))).drop("_label")


def codebooks_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def oracle_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same in DuckDB SQL, for vectors of one length that the parts divide: a pair of CTEs per round."""
    def assigned(r: int) -> str:
        return f"""a{r} AS MATERIALIZED (
  SELECT rid, part, any_value(x) AS x, min({{'d': d, 'e': e}}) AS m FROM (
    SELECT p.rid, p.part, p.x, b.e,
           list_sum(list_transform(list_zip(p.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM p JOIN b{r} b ON b.part = p.part) GROUP BY rid, part)"""

    def updated(r: int) -> str:
        return f"""b{r + 1} AS MATERIALIZED (
  SELECT b.part, b.e, coalesce(u.c, b.c) AS c FROM b{r} b LEFT JOIN (
    SELECT part, e, list((s - ((s % n) + n) % n) // n ORDER BY j) AS c FROM (
      SELECT part, e, j, sum(v)::BIGINT AS s, count(*) AS n FROM (
        SELECT part, m.e AS e, unnest(x) AS v, generate_subscripts(x, 1) AS j FROM a{r})
      GROUP BY part, e, j) GROUP BY part, e) u ON u.part = b.part AND u.e = b.e)"""

    steps = ",\n".join(f"{assigned(r)},\n{updated(r)}" for r in range(rounds))
    return f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda c: floor({scale} * c::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c)))
), p AS MATERIALIZED (
  SELECT rid, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS x
  FROM k, (SELECT unnest(range({parts})) AS part)
), b0 AS MATERIALIZED (
  SELECT p.part, f.e, p.x AS c FROM p JOIN (
    SELECT rid, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k ORDER BY vec_id LIMIT {entries}) f ON f.rid = p.rid
),
{steps},
{assigned(rounds)},
o AS (
  SELECT rid, string_agg(lpad(hex(m.e), 2, '0'), '' ORDER BY part) AS code, sum(m.d)::BIGINT AS error FROM a{rounds} GROUP BY rid
), s AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, e)) AS sha FROM b{rounds}
)
SELECT k.vec_id, lower(o.code) AS code, o.error,
       (sum(o.error) OVER (PARTITION BY k.label))::BIGINT AS label_error, s.sha AS codebooks_sha256
FROM k JOIN o ON o.rid = k.rid CROSS JOIN s
"""
