import tracemalloc
import zlib

import numpy as np
import pytest
from conftest import SF_SMALL
from corpus_fixtures import docs_of, odd  # noqa: F401
from pyspark.sql import functions as F

from lading.llm import language_id, mixing, queries, simple8b, token_output
from lading.llm.common import table


def test_codewords_differ():
    for k in (2, 3, 4, 7, 12, 40):
        code = language_id.codewords(k)
        assert code.shape[0] == k and set(np.unique(code)) <= {-1.0, 1.0}
        apart = min((code[i] != code[j]).sum() for i in range(k) for j in range(i))
        assert apart >= (1 if k == 2 else 2)


def test_language_held_out_accuracy(spark):
    got = queries.language(spark, SF_SMALL).join(table(spark, SF_SMALL, "documents").select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out AND lang IS NOT NULL").collect()
    assert len(rows) > 30
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_scores_ignore_slicing():
    model = {"langs": ["a", "b"], "code": language_id.codewords(2), "trust": np.ones(1),
             "weights": np.random.default_rng(0).normal(size=((1 << 16) + 1, 1)).astype(np.float32)}
    model["weights"][-1] = 0
    texts = ["abc def", "x", "some longer text here", "q" * 300]
    together = language_id.scores(texts, model)
    assert np.allclose(together, np.concatenate([language_id.scores([t], model) for t in texts]), atol=1e-5)


def test_language_long_texts_go_in_pieces():
    texts = ["Ab c", "", "é" * 50, "some longer text here " * 9]
    counts = [np.sum([np.bincount(language_id.buckets([r for _, r in run])[0].ravel(), minlength=(1 << 16) + 1)[:-1]
                      for run in language_id.pieces(texts, most)], axis=0) for most in (1, 7, 64, 10 ** 6)]
    assert all(np.array_equal(c, counts[-1]) for c in counts)
    rng = np.random.default_rng(0)
    model = {"langs": list("abcd"), "code": language_id.codewords(4), "trust": np.ones(7),
             "weights": rng.normal(size=((1 << 16) + 1, 7)).astype(np.float32)}
    model["weights"][-1] = 0
    text = "".join(rng.choice(list("abcdef "), 16_000_000))
    tracemalloc.start()
    got = language_id.scores([text, "abc def"], model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 250_000_000, peak
    assert np.allclose(got[1], language_id.scores(["abc def"], model)[0])


def test_language_odd_rows(spark, odd, docs_of):
    model = language_id.train(odd)
    got = {(r.doc_id, r.lang_pred, r.score == 0) for r in language_id.predict(odd, model).collect()}
    assert {(1, "und", True), (2, "und", True), (3, "und", True)} <= got
    assert {p for i, p, _ in got if i in (4, 5, 6, 7)} <= {"en", "fr", "und"}
    assert language_id.predict(odd, model).count() == odd.count()
    kept = language_id.keep_identified(odd, model)
    assert kept.columns == odd.columns
    assert language_id.train(docs_of([])) is None
    assert {r.lang_pred for r in language_id.predict(odd, None).collect()} == {"und"}
    assert language_id.predict(docs_of([]), model).count() == 0


def test_ambiguous_between_two_languages(docs_of):
    docs = docs_of([(i, "aaab bbbc caac" if i % 2 else "xxxy yyyz zxxz", "a" if i % 2 else "b") for i in range(20)])
    model = language_id.train(docs)
    got = {r.doc_id: r for r in language_id.predict(docs_of([(1, "aaab caac"), (2, "yyyz zxxz"), (3, "mmmn nnno")]), model).collect()}
    assert (got[1].lang_pred, got[1].ambiguous) == ("a", False) and (got[2].lang_pred, got[2].ambiguous) == ("b", False)
    assert got[3].ambiguous and 0.4 < got[3].score < 0.6


def shares(sizes, weights=(5, 2, 1), most=3):
    """Targets by resharing round after round."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in target]
        left = total - sum(target.values())
        now = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if now[s] > most * sizes[s]]
        if not over:
            return target | now
        target |= {s: most * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 50, "c": 7, None: 3}, {"a": 1, "b": 1000, "c": 10, "d": 10},
                                   {"a": 0, "b": 5}, {"z": 9}, {"a": 0, "b": 0}])
def test_targets_match_resharing(spark, sizes):
    rows = [(s, n) for s, n in sizes.items()]
    got = mixing.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()
    want = shares(sizes)
    assert {r.source: r.source_size for r in got} == sizes
    assert all(abs(r.target - want[r.source]) < 1e-6 for r in got)


def test_mix_repeats_and_odd_rows(spark, odd, docs_of):
    docs = docs_of([(i, "w " * 10, None, "big" if i % 10 else "small") for i in range(3000)])
    plan = mixing.mixing_plan(docs)
    sums = {r.source: r for r in plan.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"),
                                                           F.first("target").alias("target")).collect()}
    assert all(abs(r.taken - r.target) < 0.08 * r.target for r in sums.values())
    assert plan.where("copies > 3").isEmpty()
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == plan.agg(F.sum("copies")).first()[0]
    assert sorted(r.doc_id for r in mixing.mix(docs).collect()) == sorted(r.doc_id for r in mixed.collect())
    assert mixing.mixing_plan(odd).count() == odd.count()
    assert mixing.mix(odd).columns == odd.columns
    assert mixing.mix(docs_of([])).count() == 0


def test_simple8b_round_trip():
    rng = np.random.default_rng(5)
    for n in (0, 1, 59, 60, 61, 1023, 1024, 1025, 4000):
        for top in (1, 2, 50_257, 2 ** 31, 2 ** 60, 2 ** 63):
            ids = rng.integers(0, top, n, dtype=np.uint64) >> rng.integers(0, 30, n, dtype=np.uint64)
            page = simple8b.encode(ids)
            assert np.array_equal(simple8b.decode(page), ids)
            assert np.array_equal(simple8b.decode(page, 1, 3), ids[1024:3072])
    with pytest.raises(ValueError):
        simple8b.decode(b"nope" + bytes(40))


def library_ids(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_output.default_tokenizer())
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids + [0]


def test_pieces_tokenize_like_whole_texts():
    texts = ["", " ", "a  b", "x \n y", "\n\n a\t b  ", "it's    fine  ok", " lead", "tail ", "\x1c \x1c a!\x1c b",
             "café \U0001F600  \U0001F600\n", "<|endoftext|> a", "1 22  333 a1b2", "a" * 200 + " " + "b" * 200, "​ ​ x",
             " 　 y", "can't won't  we'll"]
    got = token_output.token_bytes(texts, token_output.default_tokenizer())
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == [library_ids(t)[:-1] for t in texts]


def check_tokens(docs):
    want = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, expected = 0, []
    for doc_id, text in want:
        ids = np.array(library_ids(text), "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    read = token_output.tokenized(docs).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("c"))
    assert sorted(map(tuple, read.collect()), key=repr) == sorted(expected, key=repr)


def test_tokens_odd_rows(odd, docs_of):
    check_tokens(odd)
    assert token_output.tokenized(docs_of([])).count() == 0


def test_tokens_of_the_table(spark):
    check_tokens(table(spark, SF_SMALL, "documents"))
