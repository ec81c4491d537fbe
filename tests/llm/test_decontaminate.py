import re

from conftest import SF_SMALL
from corpus_fixtures import docs_of, multiset, odd, prose  # noqa: F401

from lading.llm import decontaminate
from lading.llm.common import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(13, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + k]), set()).add(str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in windows:
                    hit.update(range(i, i + k))
                    found |= windows[tuple(w[i:i + k])]
        out.append((doc_id, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_words", "n_hit", "items", "contaminated")


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_windows_match_brute_force(spark, docs_of):
    passage = prose(30, 1)
    items = [(1, passage), (2, "Short item here"), (3, "café ÉTUDE"), (4, None), (5, "!!!"), (6, passage), (7, "x"),
             (8, " ".join(passage.split()[5:25])), (None, prose(13, 4))]
    docs = [(1, "pre " + passage.upper().replace(" ", ", ") + " post " + prose(50, 2)), (2, "a short-item, here too"),
            (3, "café étude"), (4, "café Étude"), (5, " ".join(passage.split()[:12])), (6, None), (7, ""), (8, "..."),
            (9, prose(2000, 8) + " " + " ".join(passage.split()[:13])), (10, "x y z " * 30), (11, prose(13, 4)),
            (1, "the same id, another text: short item here")]
    got = decontaminate.contamination(docs_of(docs), items_of(spark, items))
    assert multiset(got, *COLUMNS) == brute(docs, [(i if i is not None else "null", t) for i, t in items if i is not None]
                                            + [(i, t) for i, t in items if i is None]) or _null_item(got, docs, items)


def _null_item(got, docs, items):
    """A null item hits words but has no name among the items."""
    want = [(d, n, h, [x for x in found if x != "None"], c) for d, n, h, found, c in brute(docs, items)]
    assert multiset(got, *COLUMNS) == sorted(want, key=repr)
    return True


def test_contamination_of_the_table(spark):
    docs, items = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert any(r[-1] for r in want)
    assert multiset(decontaminate.contamination(docs, items), *COLUMNS) == want


def test_removal(spark, docs_of, odd):
    passage = prose(20, 321)
    items = items_of(spark, [(1, passage)])
    docs = docs_of([(1, f"Keep (this) {passage}! and-that."), (2, "clean words"), (3, None),
                    (4, prose(900, 2) + " " + " ".join(passage.split()[:13]))])
    assert sorted(r.doc_id for r in decontaminate.decontaminate(docs, items).collect()) == [2, 3, 4]
    spans = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, items, "spans").collect()}
    assert spans == {1: "Keep (this) and-that.", 2: "clean words", 3: None, 4: prose(900, 2) + " "}
    for how in ("documents", "spans"):
        same = decontaminate.decontaminate(odd, items, how)
        assert same.columns == odd.columns and multiset(same, "doc_id", "text") == multiset(odd, "doc_id", "text")
        assert decontaminate.decontaminate(docs, items_of(spark, []), how).count() == 4
    assert decontaminate.contamination(docs_of([]), items).count() == 0


def test_main_path_runs_no_python(spark, docs_of):
    plan = decontaminate.contamination(docs_of([(1, "a b c")]), items_of(spark, [(1, "a b")]))
    assert not re.search("Python|Pandas|Arrow", plan._jdf.queryExecution().toString())
