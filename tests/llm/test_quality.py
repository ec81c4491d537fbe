import random
import re

import numpy as np
from conftest import SF_SMALL
from corpus_fixtures import docs_of, odd, prose  # noqa: F401
from pyspark.sql import functions as F

from lading.llm import quality_model, quality_rules, queries
from lading.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = {}
    for i in range(len(w) - 4):
        at.setdefault(tuple(w[i:i + 5]), []).append(i)
    again = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again))


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_base_columns_match_brute_force(spark, odd):
    for docs in (table(spark, SF_SMALL, "documents"), odd):
        texts = sorted(((r.doc_id, *brute_counts(r.text)) for r in docs.collect()), key=repr)
        got = quality_rules.quality_rules(docs)
        rows = got.collect()
        assert sorted(((r.doc_id, *(r[c] for c in COLUMNS)) for r in rows), key=repr) == texts
        for r in rows:
            assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
            assert not (r.base_failed and r.kept)


def test_counts_of_shared_lines_and_windows():
    for text in ("a b c d e f a b c d e", "x\nx\n \n x\nx", "a " * 30, "éé #|<> \U0001F600", "", None, "a b c d e"):
        n, chars, symbols, _, _, _, dup, rep = quality_rules.text_counts(text)
        assert (n, chars, symbols, dup, rep) == brute_counts(text)


def test_outliers_are_rejected_and_clean_kept(docs_of):
    rng = random.Random(4)
    rows = [(i, prose(rng.randint(30, 200), i), "en", "s") for i in range(400)]
    rows += [(1000 + i, " ".join(w + rng.choice(["###", "$$$", "&&&"]) for w in prose(80, 3000 + i).split()), "en", "s") for i in range(60)]
    rows += [(2000 + i, prose(80, 4000 + i).upper(), "en", "s") for i in range(40)]
    rows += [(3000 + i, prose(80, 6000 + i), "de", "rare") for i in range(5)]     # a small group is judged by all rows
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs_of(rows)).collect()}
    assert all(r.kept or r.base_failed for d, r in got.items() if d < 1000 or d >= 3000)
    assert not any(r.kept for d, r in got.items() if 1000 <= d < 3000)


def test_estimate_ignores_a_quarter_of_outliers(spark):
    rng = np.random.default_rng(1)
    good = rng.normal(0, 200, (700, quality_rules.P)).round().astype(int)
    bad = rng.normal(9000, 50, (200, quality_rules.P)).round().astype(int)
    rows = spark.createDataFrame([("g", r) for r in np.concatenate([good, bad]).tolist()], "g string, x array<long>")
    got = quality_rules.estimates(rows).first()
    assert np.abs(np.array(got.centre)).max() < 60
    spread = np.sqrt(np.diag(np.linalg.inv(np.array(got.inverse).reshape(quality_rules.P, -1))))
    floor = np.array([1024 * s for _, s in quality_rules.STATS.values()])
    assert np.abs(spread / np.sqrt(200 ** 2 + floor ** 2) - 1).max() < 0.25


def test_chi_square():
    assert abs(quality_rules.chi2_quantile(0.05, 1) - 3.841) < 1e-3
    assert abs(quality_rules.chi2_quantile(0.01, 6) - 16.812) < 1e-3


def test_rules_on_an_empty_table(docs_of):
    assert quality_rules.quality_rules(docs_of([])).count() == 0


def test_classifier_held_out(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    got = (queries.quality_scores(spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out").collect())
    assert len(got) > 50
    assert sum(r.predicted == r.quality for r in got) >= 0.95 * len(got)


def test_classifier_odd_rows(spark, odd, docs_of):
    labelled = odd.select("doc_id", "text", F.when(F.col("doc_id") == 4, 1).when(F.col("doc_id") == 6, 0).alias("label"))
    weights = quality_model.train(labelled)
    scores = quality_model.score(odd, weights).collect()
    assert len(scores) == odd.count() and all(0 <= r.score <= 1 for r in scores)
    empty = quality_model.train(docs_of([]).select("doc_id", "text", F.lit(1).alias("label")))
    assert {r.score for r in quality_model.score(odd, empty).collect()} == {0.5}
    assert quality_model.score(docs_of([]), weights).count() == 0


def test_features_see_order_shape_and_repeats():
    a, b = quality_model.features("alpha beta")[0], quality_model.features("beta alpha")[0]
    assert set(a) != set(b) and len(set(a) & set(b)) >= 3
    assert set(quality_model.features("wher wher")[0]) != set(quality_model.features("wher other")[0])
    index, value = quality_model.features("a a a b")
    assert index[0] == 0 and value[0] == 1 and abs((value[1:] ** 2).sum() - 1) < 1e-5
    assert quality_model.features(None)[0].tolist() == [0]


def test_marks_are_taken_to_the_texts(spark, docs_of, tmp_path, monkeypatch):
    """The sample of documents and marks is that of their join, and no text is shuffled for it."""
    rows = docs_of([(None if i % 50 == 0 else i // 2 if i < 40 else i, None if i == 7 else f"good text {i} " * (1 + i % 9), None, None) for i in range(400)])
    marks = spark.createDataFrame([(i % 300 if i % 11 else None, [0, 1, None, 2][i % 4]) for i in range(600)], "doc_id int, label int")
    rows.write.parquet(f"{tmp_path}/docs")
    rows = spark.read.parquet(f"{tmp_path}/docs")
    joined = quality_model.train(rows.select("doc_id", "text").join(marks, "doc_id"), max_train=100)
    frames = []
    monkeypatch.setattr(type(rows), "mapInArrow", lambda df, run, schema, _m=type(rows).mapInArrow: frames.append(df) or _m(df, run, schema))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames.clear()
        split = quality_model.train(rows, max_train=100, marks=marks)
        plan = frames[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert (joined != 0).any() and (joined == split).all()
    texts, ids = plan.split("BroadcastExchange", 1)
    assert "text#" in texts and "Exchange hashpartitioning" not in texts and "text#" not in ids


def test_sample_is_bounded_by_bytes(docs_of):
    """One text in ten is a hundred times as long: bytes bound the sample where rows would not."""
    from lading.llm.mixing import coin

    rows = docs_of([(i, "word " * (2000 if i % 10 == 0 else 20), None, None) for i in range(2000)])
    size = 200 * 10_000 + 1800 * 100
    assert quality_model.sample_rate(rows, 5000, 10 ** 9) == 1.0
    assert quality_model.sample_rate(rows, 500, 10 ** 9) == 0.25
    rate = quality_model.sample_rate(rows, 5000, size // 10)
    assert abs(rate - 0.1) < 1e-9
    taken = rows.where(coin(F.col("doc_id"), "quality-sample") < rate).agg(F.sum(F.octet_length("text"))).first()[0]
    assert taken < 2 * size / 10
    assert quality_model.sample_rate(rows.limit(0)) == 1.0
    index, value = quality_model.features("a b c " * 1_000_000)
    assert index.nbytes + value.nbytes <= 8 * 2 ** quality_model.BITS + 8
