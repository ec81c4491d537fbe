"""Token ids by piece: texts are cut where no tokenizer joins characters, and each different piece is encoded once.

A byte-level tokenizer first splits a text with a pattern of letters, digits,
other marks and white space.  Certain bytes show where that pattern must start a
new match, whatever stands before, so a text may be cut there and its ids are
those of its pieces.  Bytes that may belong to white space outside ASCII never
count as such a place; the piece is then longer, its ids the same.

All texts of a slice are cut in one pass over their bytes.  A table of fixed size
knows the ids of pieces met before; of the others, each different one goes to
the tokenizer once a slice: words straight to its merges, the rest in long
lines, where a line feed between two pieces is always a token of its own, so
that their ids are told apart again by its id.
"""

from __future__ import annotations

import numpy as np

#: bytes that a character which is surely no white space can begin with
_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = True
_SOLID[0xC3:0xE1] = True
_SOLID[0xE4:0xF5] = True
_LETTER = np.zeros(256, bool)
_LETTER[ord("A"):ord("Z") + 1] = _LETTER[ord("a"):ord("z") + 1] = True
_MARK = np.zeros(256, bool)
_MARK[0x21:0x7F] = True
_MARK &= ~_LETTER
_MARK[ord("0"):ord("9") + 1] = False
_MARK_BEFORE = _MARK.copy()
_MARK_BEFORE[ord("'")] = False  # 's and its like begin with it
SPACE, FEED = 32, 10

#: a worker's memory: 2^bits slots of 24 bytes of piece and 8 ids, 15 MB
TABLE_BITS, KEY_BYTES, SLOT_IDS = 18, 24, 8
LINE_PIECES = 4000
#: letters up to here are letters in every version of the Unicode tables
LATIN_END = "\u0250"
#: masks of the first n bytes of a word
_BYTES_OF = np.array([2 ** (8 * n) - 1 for n in range(9)], np.uint64)


def joined(texts) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string array (null: empty) and its offsets, from 0."""
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = pc.cast(texts, pa.large_binary()).fill_null(b"")
    n = len(texts)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + n + 1]
    return np.frombuffer(data or b"", np.uint8)[at[0]:at[-1]], at - at[0]


def cut(data: np.ndarray, ends: np.ndarray, marks: bool = True) -> np.ndarray:
    """Where pieces begin: ``data`` holds texts one after the other, up to each of ``ends``.

    Always before a blank that a solid character follows, around a line feed
    that one follows, and at a text's start.  With ``marks`` also between an
    ASCII letter and a mark, which tokenizers that merge across them (``marks``
    false) must not use; those have no cut inside a run of blanks either.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    start = np.zeros(n + 1, bool)
    before_solid = np.zeros(n, bool)
    before_solid[:-1] = _SOLID[data[1:]]
    before_solid[ends[(ends > 0)] - 1] = False  # a text's last byte is followed by nothing
    blank = (data == SPACE) & before_solid
    feed = (data == FEED) & before_solid
    if marks:
        start[1:n] = (_LETTER[data[:-1]] & _MARK[data[1:]]) | (_MARK_BEFORE[data[:-1]] & _LETTER[data[1:]])
    else:
        blank[1:] &= data[:-1] != SPACE
    start[:n] |= blank | feed
    start[1:] |= feed
    start[0] = True
    start[ends] = True
    start[n] = False
    return np.flatnonzero(start)


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``flat[start:start + length]`` one after the other."""
    total = int(lengths.sum())
    at = np.arange(total, dtype=np.int64)
    at += np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return flat[at]


def distinct(data: np.ndarray, starts: np.ndarray):
    """The different pieces of ``data`` as an Arrow array, and for each piece which of them it is."""
    import pyarrow as pa

    offsets = np.append(starts, len(data)).astype(np.int64)
    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    coded = pieces.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy()


class Table:
    """Token ids of pieces met before: a table of fixed size, looked up for all pieces of a slice at once.

    A slot holds the piece itself (up to ``KEY_BYTES`` bytes, as words, and its
    length), so a hit is exact, and up to ``SLOT_IDS`` ids.  A new piece takes
    its slot when the slot is free or the piece came twice in its slice; longer
    pieces and those with more ids are encoded anew in each slice.
    """

    def __init__(self, bits: int = TABLE_BITS):
        self.bits = bits
        self.keys = np.zeros((KEY_BYTES // 8, 1 << bits), np.uint64)
        self.bytes = np.zeros(1 << bits, np.uint8)
        self.counts = np.zeros(1 << bits, np.uint8)
        self.ids = np.zeros((1 << bits, SLOT_IDS), np.uint32)

    def places(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Each piece's words, zero after its end, and its slot."""
        padded = np.concatenate([data, np.zeros(KEY_BYTES, np.uint8)])
        words = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))  # the word that begins at each byte
        keys, mixed = [], lengths.astype(np.uint64)
        for j in range(KEY_BYTES // 8):
            kept = np.clip(lengths - 8 * j, 0, 8)
            word = words[np.minimum(starts + 8 * j, len(words) - 1)] & _BYTES_OF[kept]
            mixed = (mixed ^ word) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            keys.append(word)
        return keys, (mixed * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - self.bits)).astype(np.int64)

    def known(self, keys: list[np.ndarray], slot: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        hit = (self.bytes[slot] == lengths) & (lengths <= KEY_BYTES)
        for held, key in zip(self.keys, keys):
            hit &= held[slot] == key
        return hit

    def keep(self, keys: list[np.ndarray], slot: np.ndarray, lengths: np.ndarray, often: np.ndarray,
             ids: np.ndarray, sizes: np.ndarray) -> None:
        """Remember new pieces; ``ids`` are theirs one after the other, ``sizes`` how many each has."""
        fits = (lengths <= KEY_BYTES) & (sizes <= SLOT_IDS) & (often | (self.bytes[slot] == 0))
        at = np.flatnonzero(fits)
        at = at[np.unique(slot[at], return_index=True)[1]]
        slot, sizes, starts = slot[at], sizes[at], (np.cumsum(sizes) - sizes)[at]
        rows = np.zeros((len(at), SLOT_IDS), np.uint32)
        rows[np.arange(SLOT_IDS) < sizes[:, None]] = gathered(ids, starts, sizes)
        self.ids[slot], self.counts[slot], self.bytes[slot] = rows, sizes, lengths[at]
        for held, key in zip(self.keys, keys):
            held[slot] = key[at]


class ByteLevel:
    """A byte-level tokenizer of the tokenizers library: ids of pieces.

    Strings that name special tokens are ordinary text (``encode_special_tokens``).
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.letters = str.maketrans({chr(b): letter for b, letter in byte_letters().items()})
        (self.feed,) = self.ids(["\n"])[0]

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def __call__(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``pieces``, one after the other, and how many each has."""
        tokenize, letters, blank = self.tok.model.tokenize, self.letters, self.letters[SPACE]
        out, odd = [], []
        for i, p in enumerate(pieces):
            text = p.decode("utf-8")
            bare = text[1:] if text[:1] == " " else text
            if bare.isalpha() and (bare.isascii() or max(bare) < LATIN_END):  # one match of the first step
                lettered = text.replace(" ", blank) if text.isascii() else p.decode("latin-1").translate(letters)
                out.append([t.id for t in tokenize(lettered)])  # only the merges are left
            else:
                out.append(None)
                odd.append((i, text, bare.split() == [bare]))
        for (i, _, _), ids in zip([o for o in odd if not o[2]], self.ids([o[1] for o in odd if not o[2]])):
            out[i] = ids
        # white space only as one leading blank: then a line feed beside it is a token of its own
        plain = [o for o in odd if o[2]]
        for at in range(0, len(plain), LINE_PIECES):
            line = plain[at:at + LINE_PIECES]
            ids, begin = self.ids(["\n".join([text for _, text, _ in line])])[0], 0
            for i, _, _ in line:
                end = ids.index(self.feed, begin) if i != line[-1][0] else len(ids)
                out[i], begin = ids[begin:end], end + 1
        sizes = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter((x for ids in out for x in ids), np.uint32, int(sizes.sum())), sizes

    def entries(self) -> list[bytes]:
        """The bytes of each id's entry, by id."""
        vocab = self.tok.get_vocab(with_added_tokens=True)
        bytes_of = {c: b for b, c in byte_letters().items()}
        out = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            out[i] = bytes(map(bytes_of.__getitem__, entry)) if all(c in bytes_of for c in entry) else entry.encode("utf-8")
        return out


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable bytes stand for themselves."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class TextIds:
    """Token ids of texts by their pieces."""

    def __init__(self, path: str):
        self.table, self.encode = Table(), ByteLevel(path)

    def __call__(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of an Arrow string array, one text after the other, and where each text's ids end."""
        data, offsets = joined(texts)
        starts = cut(data, offsets[:-1])
        lengths = np.diff(starts, append=len(data))
        keys, slot = self.table.places(data, starts, lengths)
        hit = self.table.known(keys, slot, lengths)
        new = np.flatnonzero(~hit)
        pieces, which = distinct(gathered(data, starts[new], lengths[new]), np.cumsum(lengths[new]) - lengths[new])
        ids, sizes = self.encode(pieces.to_pylist())
        pool = np.concatenate([self.table.ids.reshape(-1), ids])
        at, counts = slot * SLOT_IDS, self.table.counts[slot].astype(np.int64)
        at[new], counts[new] = self.table.ids.size + (np.cumsum(sizes) - sizes)[which], sizes[which]
        out = gathered(pool, at, counts)
        first = np.zeros(len(pieces), np.int64)
        first[which[::-1]] = new[::-1]
        self.table.keep([k[first] for k in keys], slot[first], lengths[first], np.bincount(which, minlength=len(pieces)) > 1,
                        ids, sizes)
        before = np.concatenate([[0], np.cumsum(counts)])
        return out, before[np.searchsorted(starts, offsets[1:])]


def slices(batches, column: int, most: int):
    """Runs of rows of ``batches`` with about ``most`` bytes of text in ``column``; one long text is a run by itself."""
    import pyarrow.compute as pc

    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = size[at - 1] if at else 0
            end = max(int(np.searchsorted(size, done + most, "right")), at + 1)
            yield batch.slice(at, end - at)
            at = end
