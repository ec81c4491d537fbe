"""Simple-8b: 64-bit words of a 4-bit selector and 60 payload bits.

A page of ids is cut into blocks of ``BLOCK`` ids.  Every block starts a new
word and the page keeps each block's word offset, so blocks decode on their
own.  In a block, each word takes as many of the next ids as one selector's
width holds; past the block's end ids count as 0 and are dropped again.  An id
of more than 60 bits is escaped: its word holds an index into the page's list
of whole 64-bit ids.

Page layout, little-endian: magic, then as u32 the block size, the number of
blocks, words and escapes, u64 the number of ids; block offsets as u32, words
as u64, escapes as u64.
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK = 1024
MAGIC = b"S8B1"
HEAD = "<4sIIIIQ"
HEAD_SIZE = struct.calcsize(HEAD)
ESCAPE = 0
#: selector -> (ids in a word, bits of each)
WIDTHS = {1: (60, 1), 2: (30, 2), 3: (20, 3), 4: (15, 4), 5: (12, 5), 6: (10, 6), 7: (8, 7), 8: (7, 8),
          9: (6, 10), 10: (5, 12), 11: (4, 15), 12: (3, 20), 13: (2, 30), 14: (1, 60)}


def _bits(ids: np.ndarray) -> np.ndarray:
    """Bit length of each id."""
    if ids.size and ids.max() < 2 ** 53:  # exact as doubles, whose exponent it is
        return np.frexp(ids.astype(np.float64))[1].astype(np.uint8)
    out = np.zeros(ids.shape, np.uint8)
    rest = ids.copy()
    for step in (32, 16, 8, 4, 2, 1):
        more = (rest >> np.uint64(step)) > 0
        out += np.where(more, step, 0).astype(np.uint8)
        rest = np.where(more, rest >> np.uint64(step), rest)
    return out + (rest > 0)


def _ahead(x: np.ndarray, by: int) -> np.ndarray:
    """Each row moved ``by`` to the left, zeros behind."""
    out = np.zeros_like(x)
    if by < x.shape[1]:
        out[:, :-by] = x[:, by:]
    return out


def encode(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """A page of any number of ids (unsigned, up to 64 bits)."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    blocks = -(-n // block)
    grid = np.zeros((blocks, block), np.uint64)
    grid.reshape(-1)[:n] = ids
    # the widest id among the next 2^j, then among the next c for every selector
    most = [_bits(grid)]
    while 2 ** len(most) <= WIDTHS[1][0]:
        most.append(np.maximum(most[-1], _ahead(most[-1], 2 ** (len(most) - 1))))
    pick = np.full(grid.shape, ESCAPE, np.uint8)
    for sel in sorted(WIDTHS, reverse=True):
        c, width = WIDTHS[sel]
        j = c.bit_length() - 1
        wide = most[j] if c == 2 ** j else np.maximum(most[j], _ahead(most[j], c - 2 ** j))
        pick[wide <= width] = sel
    counts = np.array([1] + [WIDTHS[s][0] for s in range(1, 15)], np.int64)
    # all blocks walk their words in step
    step, ends = counts[pick].reshape(-1), np.minimum((np.arange(blocks) + 1) * block, n)
    at, walked = np.arange(blocks) * block, []
    while len(at):
        walked.append(at)
        at = at + step[at]
        ahead = at < ends
        at, ends = at[ahead], ends[ahead]
    starts = np.sort(np.concatenate(walked)) if walked else np.zeros(0, np.int64)
    offsets = np.searchsorted(starts, np.arange(blocks) * block)
    sel = pick.reshape(-1)[starts] if n else np.zeros(0, np.uint8)
    words = sel.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate([grid, np.zeros((blocks, 64), np.uint64)], axis=1)
    flat = padded.reshape(-1)
    place = starts + (starts // block) * 64  # a start's place in the padded rows
    for s, (c, width) in WIDTHS.items():
        at = np.flatnonzero(sel == s)
        if len(at):
            got = flat[place[at][:, None] + np.arange(c)]
            words[at] |= np.bitwise_or.reduce(got << (np.arange(c, dtype=np.uint64) * np.uint64(width)), axis=1)
    at = np.flatnonzero(sel == ESCAPE)
    escapes = flat[place[at]] if len(at) else np.zeros(0, np.uint64)
    words[at] |= np.arange(len(at), dtype=np.uint64)
    return (struct.pack(HEAD, MAGIC, block, blocks, len(words), len(escapes), n)
            + offsets.astype("<u4").tobytes() + words.astype("<u8").tobytes() + escapes.astype("<u8").tobytes())


def decode(page: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of blocks ``first`` up to ``last`` (all by default) of a page."""
    magic, block, blocks, n_words, n_escapes, n = struct.unpack_from(HEAD, page)
    if magic != MAGIC:
        raise ValueError("not a Simple-8b page")
    last = blocks if last is None else min(last, blocks)
    first = min(first, last)
    offsets = np.append(np.frombuffer(page, "<u4", blocks, HEAD_SIZE), n_words).astype(np.int64)
    base = HEAD_SIZE + 4 * blocks
    words = np.frombuffer(page, "<u8", n_words, base)[offsets[first]:offsets[last]]
    escapes = np.frombuffer(page, "<u8", n_escapes, base + 8 * n_words)
    n_out = min(n, last * block) - first * block
    if n_out <= 0:
        return np.zeros(0, np.uint64)
    sel = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array([1] + [WIDTHS[s][0] for s in range(1, 15)], np.int64)[sel]
    # where each word's ids begin: words of a block follow each other from the block's start
    in_block = np.repeat(np.arange(last - first), np.diff(offsets[first:last + 1]))
    before = np.cumsum(counts) - counts
    heads = offsets[first:last] - offsets[first]
    start = in_block * block + before - before[heads][in_block]
    end = np.minimum((in_block + 1) * block, n_out)
    out = np.zeros(n_out, np.uint64)
    for s, (c, width) in WIDTHS.items():
        at = np.flatnonzero(sel == s)
        if len(at):
            span = np.arange(c)
            got = (words[at][:, None] >> (span.astype(np.uint64) * np.uint64(width))) & np.uint64((1 << width) - 1)
            where = start[at][:, None] + span
            real = where < end[at][:, None]
            out[where[real]] = got[real]
    at = np.flatnonzero(sel == ESCAPE)
    out[start[at]] = escapes[(words[at] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return out
