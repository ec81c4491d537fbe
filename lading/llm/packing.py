"""Best-fit packing: documents' token ids into sequences of at most ``size`` ids.

Each task packs the documents it reads, in one pass and without a shuffle:
bounded-space online best fit.  A fixed number of bins is open; they are kept
by their free space, and a bitset has bit f set while a bin with f free ids is
open.  The bin for a piece is the lowest set bit from its length on (the best
fit); if there is none, a bin is opened, and if that would be one too many the
fullest, the lowest set bit of all, closes first.

What a task's end finds in bins that are not nearly full is packed again the
same way by tasks that each take ``REPACK_IDS`` ids of it, so that many small
tasks do not leave many half-empty sequences.  A sequence never spans tasks.

Defined cases: a null text is empty and still has its end id; a null doc_id
stays null; rows that repeat a doc_id are packed each by itself; an empty table
gives no rows; columns other than ``doc_id`` and ``text`` are not read.  Strings
that name special tokens are ordinary text, as in ``token_output``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lading.llm import pieces
from lading.llm.common import mapped, staged
from lading.llm.token_output import END_ID, SLICE_BYTES, default_tokenizer, ended_ids

SIZE = 2048
#: bins a task keeps open; their ids are in its memory
OPEN_BINS = 1024
#: at a task's end a bin with at most this share of its size free closes as it is
NEARLY = 64
#: ids that one task packs again
REPACK_IDS = 8_000_000

SCHEMA = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long, open boolean"


class Bins:
    """Open bins of ``size`` by their free space, at most ``most`` of them."""

    def __init__(self, size: int, most: int):
        self.size, self.most, self.open = size, most, 0
        self.bits = 0
        self.by_free: list[list] = [[] for _ in range(size + 1)]

    def _take(self, free: int) -> list:
        """A bin with ``free`` free, no longer open."""
        found = self.by_free[free].pop()
        if not self.by_free[free]:
            self.bits ^= 1 << free
        self.open -= 1
        return found

    def put(self, length: int, item) -> list[list]:
        """Place an item; the bins that this closes."""
        closed = []
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            into = self._take(free)
        else:
            if self.open == self.most:
                closed.append(self._take((self.bits & -self.bits).bit_length() - 1))
            free, into = self.size, []
        into.append(item)
        left = free - length
        if left:
            self.by_free[left].append(into)
            self.bits |= 1 << left
            self.open += 1
        else:
            closed.append(into)
        return closed

    def rest(self):
        """(bin, its free space) of all open bins, the fullest first."""
        for free, found in enumerate(self.by_free):
            for one in found:
                yield one, free


class _Rows:
    """Output rows; an item is (doc_id, piece, start, length, ids)."""

    def __init__(self, first_id: int):
        self.sequence, self.columns = first_id, [[] for _ in range(8)]

    def add(self, items: list, still_open: bool = False) -> None:
        offset = 0
        for item in items:
            for column, value in zip(self.columns, (*item, self.sequence, offset, still_open)):
                column.append(value)
            offset += item[3]
        self.sequence += 1

    def batch(self):
        import pyarrow as pa

        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.bool_())
        names = ("doc_id", "piece", "start", "length", "ids", "sequence_id", "offset", "open")
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(self.columns, kinds)], names=names)
        self.columns = [[] for _ in range(8)]
        return out


def _pack_partition(path: str, end_id: int, size: int, open_bins: int):
    def run(batches):
        from pyspark import TaskContext

        bins, rows = Bins(size, open_bins), _Rows(TaskContext.get().partitionId() << 32)
        for some in pieces.slices(batches, 1, SLICE_BYTES):
            ids, ends = ended_ids(some.column(1), path, end_id)
            raw, begin, parts = memoryview(ids.tobytes()), 0, []
            for doc_id, end in zip(some.column(0).to_pylist(), ends.tolist()):
                first = (end - begin) % size or size
                parts.append((first, (doc_id, 0, 0, first, bytes(raw[4 * begin:4 * (begin + first)]))))
                for k, at in enumerate(range(begin + first, end, size), 1):
                    rows.add([(doc_id, k, at - begin, size, bytes(raw[4 * at:4 * (at + size)]))])
                begin = end
            for length, item in sorted(parts, key=lambda part: -part[0]):  # a slice's long pieces first
                for one in bins.put(length, item):
                    rows.add(one)
            yield rows.batch()
        for one, free in bins.rest():
            rows.add(one, free * NEARLY > size)
        yield rows.batch()

    return run


def _repack_partition(size: int, open_bins: int):
    def run(batches):
        from pyspark import TaskContext

        # the first pass has fewer than 2^30 tasks, so its ids stay below these
        bins, rows = Bins(size, open_bins), _Rows(((1 << 30) + TaskContext.get().partitionId()) << 32)
        for batch in batches:
            for item in zip(*(batch.column(i).to_pylist() for i in range(5))):
                for one in bins.put(item[3], item):
                    rows.add(one)
            yield rows.batch()
        for one, _ in bins.rest():
            rows.add(one)
        yield rows.batch()

    return run


def pack(docs: DataFrame, size: int = SIZE, tokenizer: str | None = None, end_id: int = END_ID,
         open_bins: int = OPEN_BINS) -> DataFrame:
    """``doc_id, piece, start, length, ids, sequence_id, offset`` per piece; ``ids`` are little-endian u32 bytes.

    A document of more than ``size`` ids is cut into pieces of ``size``, the
    first of which may be shorter; no other document is cut.
    """
    run = _pack_partition(tokenizer or default_tokenizer(), end_id, size, open_bins)
    once = staged(mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, SCHEMA, keep="tokenizer"), "packed", "zstd")
    columns = ["doc_id", "piece", "start", "length", "ids"]
    rest = once.where("open").select(*columns)
    groups = -(-(rest.agg(F.sum("length")).first()[0] or 0) // REPACK_IDS) or 1
    again = mapped(rest.repartition(groups).sortWithinPartitions(F.desc("length"), *columns),
                   _repack_partition(size, open_bins), SCHEMA)
    return once.where("NOT open").union(again).drop("open")
