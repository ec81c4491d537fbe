import random
import re
from collections import defaultdict

import numpy as np
from conftest import SF_SMALL
from corpus_fixtures import docs_of, multiset, odd, prose  # noqa: F401

from lading.llm import line_dedup, near_dedup, repeats
from lading.llm.common import table
from lading.llm.queries import QUERIES

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingle_set(text, k):
    w = WORD.findall((text or "").encode().lower())
    return {tuple(w[i:i + min(k, len(w))]) for i in range(len(w) - min(k, len(w)) + 1)} if w else set()


def brute_components(rows, k, threshold):
    """Smallest doc_id reachable over links, by comparing all documents that share a shingle."""
    sets, parent = defaultdict(list), {}
    for doc_id, text in rows:
        if doc_id is not None:
            sets[doc_id].append(shingle_set(text, k))
            parent[doc_id] = doc_id

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = defaultdict(set)
    for d, many in sets.items():
        for s in many:
            for g in s:
                by[g].add(d)
    for a, b in {(a, b) for ds in by.values() for a in ds for b in ds if a < b}:
        if any(100 * len(x & y) >= threshold * len(x | y) > 0 for x in sets[a] for y in sets[b]):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {d: find(d) for d in parent}


def edited(text, every, seed):
    words = text.split()
    return " ".join(f"zz{seed}x{i}" if i % every == seed % every else w for i, w in enumerate(words))


def test_near_duplicates_match_brute_force(docs_of):
    rows = [(i, prose(60 + i % 50, 1000 + i)) for i in range(60)]
    base = prose(200, 7)
    rows += [(100 + i, edited(base, 20 + 3 * i, i)) for i in range(40)]        # around the threshold, many components
    rows += [(200 + i, prose(30, 9)) for i in range(30)]                      # exact copies
    rows += [(300, "Two words"), (301, "two WORDS"), (302, "two"), (303, "")]
    got = {r.doc_id: r for r in near_dedup.near_duplicates(docs_of(rows), shingle_words=4).collect()}
    want = brute_components(rows, 4, 80)
    assert {d: r.component_id for d, r in got.items()} == want
    assert {d: r.n_shingles for d, r in got.items()} == {d: len(shingle_set(t, 4)) for d, t in rows}
    assert all(r.kept == (d == want[d]) for d, r in got.items())
    assert len(set(want.values())) > 62


def test_links_between_stars_are_found(docs_of):
    """A chain whose ends share no link: components need links that no star has."""
    rows, text = [], prose(120, 3).split()
    for i in range(12):
        text = [*text]
        for j in range(2):
            text[(i * 7 + j * 31) % len(text)] = f"new{i}x{j}"
        rows.append((50 - i, " ".join(text)))
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs_of(rows), 4).collect()}
    assert got == brute_components(rows, 4, 80)


def test_blocks_cover_every_pair(docs_of, monkeypatch):
    """Bands of many blocks: a large component, strays beside it, and components that only strays tie together."""
    base = prose(150, 21)
    rows = [(i, edited(base, 40 + i % 60, i)) for i in range(60)] + [(100 + i, edited(base, 9 + i % 5, i)) for i in range(40)]
    want = brute_components(rows, 4, 80)
    assert 1 < len(set(want.values())) < len(rows)
    for nodes, members in ((3, 4_000_000), (4000, 300)):
        monkeypatch.setattr(near_dedup, "BLOCK", nodes)
        monkeypatch.setattr(near_dedup, "BLOCK_MEMBERS", members)
        got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs_of(rows), 4).collect()}
        assert got == want


def test_the_kept_row_of_a_repeated_id_is_always_the_same(docs_of):
    rows = [(1, prose(30, s)) for s in range(6)]
    kept = {near_dedup.deduplicate(docs_of(rows[at:] + rows[:at], 1 + at)).first().text for at in range(3)}
    assert len(kept) == 1


def test_near_duplicates_odd_rows(odd, docs_of):
    got = multiset(near_dedup.near_duplicates(odd), "doc_id", "component_id", "kept")
    assert len(got) == odd.count()
    assert (None, None, True) in got and (3, 3, True) in got
    kept = near_dedup.deduplicate(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 2, 3, 4, 5, 6, 7]
    assert near_dedup.near_duplicates(docs_of([])).count() == 0
    assert near_dedup.deduplicate(docs_of([])).count() == 0


def test_rows_of_one_id_tie_their_classes(docs_of):
    a, b = prose(50, 1), prose(50, 2)
    got = {(r.doc_id, r.component_id) for r in near_dedup.near_duplicates(docs_of([(9, a), (9, b), (3, a), (5, b)]), 4).collect()}
    assert got == {(9, 3), (3, 3), (5, 3)}


def test_registers_merge_and_estimate():
    mult = near_dedup.multipliers()
    a, b = near_dedup.shingles(prose(900, 1), 1), near_dedup.shingles(prose(900, 2), 5)
    both = near_dedup.registers(np.unique(np.concatenate([a, b])), mult)
    assert np.array_equal(both, np.maximum(near_dedup.registers(a, mult), near_dedup.registers(b, mult)))
    rng = np.random.default_rng(0)
    x = np.unique(rng.integers(0, 2 ** 63, 1000, dtype=np.uint64))
    for share, expect in ((0.95, True), (0.3, False), (0.0, False)):
        y = np.unique(np.concatenate([x[:int(len(x) * share)], rng.integers(0, 2 ** 63, int(len(x) * (1 - share)), dtype=np.uint64)]))
        rx, ry = (near_dedup.registers(v, mult)[None] for v in (x, y))
        assert near_dedup.possible(rx, ry, np.array([len(x)]), np.array([len(y)]), 80)[0] == expect


def brute_repeats(rows, least=50):
    seen, found = defaultdict(list), defaultdict(set)
    for key, (doc_id, text) in enumerate(rows):
        w = WORD.findall((text or "").encode().lower())
        for i in range(len(w) - least + 1):
            seen[tuple(w[i:i + least])].append((key, i))
    for places in seen.values():
        if len({k for k, _ in places}) > 1:
            for k, i in places:
                found[k].update(range(i, i + least))
    return {(rows[k][0], tuple(sorted(v))) for k, v in found.items()}


def covered(df):
    out = defaultdict(set)
    for r in df.collect():
        out[r.doc_id].update(range(r.start, r.start + r.n_words))
    return {(d, tuple(sorted(v))) for d, v in out.items()}


def test_repeats_match_brute_force(docs_of):
    passages = [prose(n, 500 + n) for n in (49, 50, 51, 60, 75, 200)]
    rows = [(i, prose(40 + i, i) + " " + passages[i % 6] + " " + prose(30, 900 + i)) for i in range(24)]
    rows += [(100, passages[5]), (101, prose(300, 5)), (102, prose(300, 5)), (103, "so " * 200), (104, "x " + "so " * 150)]
    rows += [(110 + i, " ".join(passages[4].split()[:40] + prose(20, 3 + i).split())) for i in range(5)]
    assert covered(repeats.repeated_spans(docs_of(rows))) == brute_repeats(rows)


def test_many_documents_share_a_passage(docs_of):
    passage = prose(70, 77)
    rows = [(i, f"{prose(20, i)} {passage} {prose(20, 5000 + i)}") for i in range(400)]
    assert covered(repeats.repeated_spans(docs_of(rows, 8))) == brute_repeats(rows)


def test_repeats_of_the_table(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert covered(repeats.repeated_spans(docs)) == brute_repeats(rows)


def edited_copies(groups, copies, n_words=300, gap=45, seed=0):
    """Groups of copies of one text, each with other words changed."""
    rng, rows = random.Random(seed), []
    for g in range(groups):
        base = prose(n_words, 7000 + g).split()
        for c in range(copies):
            words = [f"x{g}y{c}z{i}" if rng.random() < 1 / gap else w for i, w in enumerate(base)]
            rows.append((g * copies + c, " ".join(words)))
    return rows


def test_repeats_of_edited_copies(docs_of):
    rows = edited_copies(12, 30)
    assert covered(repeats.repeated_spans(docs_of(rows, 8))) == brute_repeats(rows)


def test_repeats_of_grams_in_parts(docs_of, monkeypatch):
    """Grams with many surroundings, sorted in several parts and cut into several batches."""
    monkeypatch.setattr(repeats, "PART", 7)
    monkeypatch.setattr(repeats, "ROWS", 50)
    passage = prose(70, 77)
    rows = edited_copies(4, 40) + [(1000 + i, f"{prose(20, i)} {passage} {prose(20, 5000 + i)}") for i in range(120)]
    found = repeats.repeated_spans(docs_of(rows, 8))
    assert covered(found) == brute_repeats(rows)
    assert cuts(found) == brute_cuts(rows)


def test_few_suffixes_are_retained():
    w = repeats.word_hashes(prose(20_000, 9))
    key, _, at, first, last = repeats.retained(w, repeats.GRAM, repeats.MIN_WORDS)
    assert len(at) < len(w) / 10
    assert list(first[1:]) == list(last[:-1] + 1) and (first[0], last[-1]) == (0, len(w) - repeats.MIN_WORDS)
    assert ((first <= at) & (at + repeats.GRAM <= last + repeats.MIN_WORDS)).all()


def test_unlike_texts_under_one_id(docs_of):
    passage, other = prose(60, 1), prose(100, 2)
    rows = [(1, f"a {passage} b"), (4, f"c {passage} d"), (4, other), (4, "short"), (None, other + " e"), (None, prose(80, 3))]
    out = sorted((r.text for r in repeats.remove_repeats(docs_of(rows, 3)).collect()))
    assert out == sorted([f"a {passage} b", "c d", "", "short", other + " e", prose(80, 3)])


def test_remove_repeats_keeps_the_first(docs_of, odd):
    passage = prose(60, 1)
    docs = docs_of([(2, f"aa {passage} bb"), (1, f"cc {passage}\ndd"), (3, "ee " + passage)])
    assert multiset(repeats.remove_repeats(docs), "doc_id", "text") == [(1, f"cc {passage}\ndd"), (2, "aa bb"), (3, "ee ")]
    assert multiset(repeats.remove_repeats(odd), "doc_id", "text") == multiset(odd, "doc_id", "text")
    assert repeats.remove_repeats(odd).columns == odd.columns
    assert repeats.repeated_spans(docs_of([])).count() == 0
    twice = docs_of([(None, passage), (None, passage), (4, passage), (4, passage)])
    assert repeats.repeated_spans(twice).count() == 4


def brute_cuts(rows, least=50):
    """Words in ``least`` equal words of a smaller document."""
    owner, gone = {}, defaultdict(set)
    words = [(doc_id, WORD.findall((text or "").encode().lower())) for doc_id, text in rows]
    for doc_id, w in words:
        for i in range(len(w) - least + 1):
            key = tuple(w[i:i + least])
            owner[key] = min(owner.get(key, doc_id), doc_id)
    for doc_id, w in words:
        for i in range(len(w) - least + 1):
            if owner[tuple(w[i:i + least])] < doc_id:
                gone[doc_id].update(range(i, i + least))
    return {(d, tuple(sorted(v))) for d, v in gone.items()}


def cuts(df):
    out = defaultdict(set)
    for r in df.collect():
        for start, n in r.cut:
            assert r.start <= start and start + n <= r.start + r.n_words
            out[r.doc_id].update(range(start, start + n))
    return {(d, tuple(sorted(v))) for d, v in out.items() if v}


def test_one_of_many_sharers_keeps_a_passage(docs_of):
    passage = prose(70, 77)
    rows = [(i, f"{prose(20, i)} {passage} {prose(20, 5000 + i)}") for i in range(400)]
    docs = docs_of(rows, 8)
    assert cuts(repeats.repeated_spans(docs)) == brute_cuts(rows)
    assert [r.doc_id for r in repeats.remove_repeats(docs).collect() if passage in r.text] == [0]


def test_touching_passages_and_classes_keep_one_copy(docs_of):
    p, q, s, t = (prose(80, i) for i in (1, 2, 3, 4))
    rows = [(3, f"a {p} b"), (50, f"c {p} {q} d"), (100, f"e {q} f"), (110, f"g {p} h {s} i"), (120, f"g {p} h {s} i"),
            (130, f"{s} j"), (140, f"{t} k"), (None, f"l {t} m")]
    out = {r.doc_id: r.text for r in repeats.remove_repeats(docs_of(rows)).collect()}
    assert {x: [d for d, text in out.items() if x in text] for x in (p, q, s, t)} == {p: [3], q: [50], s: [110], t: [None]}
    assert (out[50], out[110], out[120], out[130]) == (f"c {q} d", f"g h {s} i", "", "j")
    rows = [r for r in rows if r[0] is not None] + edited_copies(2, 20)
    rows = [(10 * i, text) for i, (_, text) in enumerate(rows)]
    assert cuts(repeats.repeated_spans(docs_of(rows))) == brute_cuts(rows)


def test_query_returns_what_is_cut(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    gone = defaultdict(set)
    found = QUERIES["op4_suffix_array_dedup"](spark, SF_SMALL).collect()
    for r in found:
        ranges = [tuple(map(int, c.split("+"))) for c in r.cut.split(",") if c]
        assert r.n_cut == sum(n for _, n in ranges)
        for start, n in ranges:
            gone[r.doc_id].update(range(start, start + n))
    assert gone and {(d, tuple(sorted(v))) for d, v in gone.items()} == brute_cuts(rows)


def test_boilerplate_lines_leave(docs_of, odd):
    rows = [(i, f"  Footer line \nown {i}\n\nnear {i % 9}", None, f"site{i % 12}") for i in range(120)]
    rows.append((500, "Footer line", None, None))
    docs = docs_of(rows)
    got = {r.doc_id: r for r in line_dedup.remove_boilerplate(docs).collect()}
    joined = line_dedup.remove_boilerplate(docs, broadcast_keys=0)
    columns = ("doc_id", "text", "n_lines", "n_removed")
    assert multiset(joined, *columns) == multiset(line_dedup.remove_boilerplate(docs), *columns)
    assert all(r.n_removed == 1 for r in got.values())
    assert got[7].text == "own 7\n\nnear 7" and got[7].n_lines == 4
    assert got[500].text == ""
    cut = line_dedup.remove_boilerplate(odd)
    assert multiset(cut, "doc_id", "text") == multiset(odd, "doc_id", "text")
    assert set(odd.columns) <= set(cut.columns)
    assert line_dedup.remove_boilerplate(docs_of([])).count() == 0


def test_lines_near_the_threshold_are_counted(docs_of):
    rows = [(100 * n + i, f"line on {n} sites", None, f"s{i}") for n in (8, 9, 10, 11, 12, 13) for i in range(n)]
    rows += [(9000 + i, "line on 8 sites", None, f"s{i % 8}") for i in range(50)]
    got = {r.doc_id // 100: r.n_removed for r in line_dedup.remove_boilerplate(docs_of(rows)).collect()}
    assert got == {8: 0, 9: 0, 10: 1, 11: 1, 12: 1, 13: 1, 90: 0}


def test_lines_are_cut_by_sorted_hashes(docs_of):
    """The cut of every text equals a plain one, with no, one and many hashes, empty and null texts."""
    texts = ["", None, "a", "a\nb\n\na", "\n", " b \nc", "\n".join(f"l{i % 7}" for i in range(100))]
    docs = docs_of([(i, t, f"s{i}", None) for i, t in enumerate(texts)])
    for lines in (set(), {"b"}, {"a", "b", "l3", "l6"}):
        shared = sorted(r[0] for r in docs.sparkSession.createDataFrame([(x,) for x in lines], "x string")
                        .selectExpr("xxhash64(x)").collect())

        class Held:
            value = np.array(shared, np.int64)

        got = docs.select("doc_id", line_dedup._cutter(Held)("text", line_dedup.line_keys(docs.text)).alias("c")).select("doc_id", "c.*")
        want = {}
        for i, t in enumerate(texts):
            kept = None if t is None else [x for x in t.split("\n") if x.strip() not in lines]
            want[i] = (t if t is None else "\n".join(kept), 0 if t is None else len(t.split("\n")) - len(kept))
        assert {r.doc_id: (r.text, r.n_removed) for r in got.collect()} == want
