"""Trained operators against plain versions of the same steps: loops and dicts, no hashing tricks of arrays shared."""

import math
from collections import defaultdict

import numpy as np
from conftest import SF_SMALL
from corpus_fixtures import docs_of, odd, prose  # noqa: F401
from pyspark.sql import functions as F

from lading.llm import language_id, quality_model, quality_rules, queries
from lading.llm.common import table

MASK = 0xFFFFFFFF


def plain_language(text, model):
    """The language of a text by one loop over its n-grams, and the score."""
    raw = b" " + text.lower().encode("utf-8").translate(language_id.FOLD) + b" " * language_id.PAD
    bits = model["weights"].shape[1]
    margin, places = [0.0] * bits, len(raw) - language_id.PAD
    for at in range(places):
        for n in language_id.NGRAMS:
            h = (int.from_bytes(raw[at:at + n], "big") + n * 0x51ED27) * 0x9E3779B1 & MASK
            row = model["weights"][((h ^ h >> 15) * 0x85EBCA6B & MASK) >> 32 - language_id.BUCKET_BITS]
            margin = [m + float(x) for m, x in zip(margin, row)]
    root = math.sqrt((places + language_id.PAD) * len(language_id.NGRAMS))
    loss = [sum(t * math.log1p(math.exp(-m / root * c)) for m, c, t in zip(margin, code, model["trust"])) for code in model["code"]]
    near = [math.exp(min(loss) - x) for x in loss]
    return model["langs"][loss.index(min(loss))], max(near) / sum(near)


def test_language_decoding_is_the_plain_loops(spark):
    docs = table(spark, SF_SMALL, "documents")
    learn = docs.where(~language_id.held_out(F.col("doc_id"), 3, 1))
    model = language_id.train(learn.select("doc_id", "text", "lang"))
    texts = {r.doc_id: r.text for r in docs.where("length(text) < 3000").collect()}
    got = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    judged = 0
    for doc_id, text in texts.items():
        r = got[doc_id]
        if not any(map(str.isalpha, text or "")):
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        lang, score = plain_language(text, model)
        judged += 1
        assert r.lang_pred == lang and abs(r.score - score) < 1e-3
    assert judged > 50


def plain_ftrl(examples):
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= quality_model.L1:
            return 0.0
        return -(z[i] - math.copysign(quality_model.L1, z[i])) / ((quality_model.BETA + math.sqrt(n[i])) / quality_model.ALPHA + quality_model.L2)

    for idx, x, label in examples:
        w = [weight(i) for i in idx]
        g = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x)))) - label
        for i, a, b in zip(idx, w, x):
            rate = (math.sqrt(n[i] + (g * b) ** 2) - math.sqrt(n[i])) / quality_model.ALPHA
            z[i] += g * b - rate * a
            n[i] += (g * b) ** 2
    return {i: weight(i) for i in z}


def test_ftrl_is_the_plain_loops():
    rng = np.random.default_rng(3)
    examples = []
    for k in range(120):
        text = prose(int(rng.integers(0, 30)), k) + (" ### $$$ BUY" if k % 3 == 0 else "")
        examples.append((*quality_model.features(text), int(k % 3 != 0)))
    got = quality_model.fit(examples * 3)
    plain = plain_ftrl([([int(i) for i in idx], [float(v) for v in x], y) for idx, x, y in examples * 3])
    assert set(np.flatnonzero(got)) <= set(plain)
    assert all(abs(got[i] - w) < 1e-4 for i, w in plain.items())


def test_scores_are_sparse_dot_products(spark, odd):
    labelled = odd.select("doc_id", "text", F.when(F.col("doc_id") == 4, 1).when(F.col("doc_id") == 6, 0).alias("label"))
    weights = quality_model.train(labelled)
    want = []
    for r in odd.collect():
        idx, x = quality_model.features(r.text)
        dot = sum(float(weights[i]) * float(v) for i, v in zip(idx, x))
        want.append((repr(r.doc_id), 1 / (1 + math.exp(-dot))))
    got = sorted((repr(r.doc_id), r.score) for r in quality_model.score(odd, weights).collect())
    assert [g[0] for g in got] == [w[0] for w in sorted(want)]
    assert np.allclose([g[1] for g in got], [w[1] for w in sorted(want)], atol=1e-5)


def plain_vector(c):
    parts = [math.log(c["word_chars"] / c["n_words"]), *(math.sqrt(c[k] / c["word_chars"]) for k in ("n_symbols", "n_signs", "n_capitals")),
             math.sqrt(c["n_dup_lines"] / c["n_lines"]), math.sqrt(c["n_repeat_words"] / c["n_words"])]
    return [math.floor(abs(p) * quality_rules.UNIT + 0.5) * (1 if p >= 0 else -1) for p in parts]


def plain_estimate(x):
    """Centre and inverse covariance of a group by concentration steps from its medians."""
    floor = np.diag([(quality_rules.UNIT * s) ** 2 for _, s in quality_rules.STATS.values()])
    low, centre, high = np.percentile(x, (25, 50, 75), axis=0)
    inverse = np.linalg.inv(np.diag(((high - low) / 1.349) ** 2) + floor)
    p = x.shape[1]
    scale = quality_rules.COVER / quality_rules.chi2_cdf(quality_rules.chi2_quantile(1 - quality_rules.COVER, p), p + 2)
    for _ in range(quality_rules.STEPS):
        d = np.einsum("ri,ij,rj->r", x - centre, inverse, x - centre)
        bins = np.floor(np.log2(np.maximum(d, 2.0 ** -20)) * quality_rules.BINS + 1e-12)
        cut = max(b for b in set(bins) if (bins < b).sum() < len(x) * quality_rules.COVER)
        inside = x[bins <= cut]
        centre = inside.mean(axis=0)
        inverse = np.linalg.inv(scale * np.cov(inside.T, bias=True) + floor)
    return centre, inverse


def test_verdicts_are_the_plain_estimates(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    docs = table(spark, sf, "documents").collect()
    passed, groups = {}, defaultdict(list)
    for r in docs:
        c = dict(zip(quality_rules.COUNTS, quality_rules.text_counts(r.text)))
        if c["n_words"] < 10 or 100 * c["n_repeat_words"] > 20 * c["n_words"]:
            continue
        x = plain_vector(c)
        passed[r.doc_id] = (c["n_words"], x, r.lang, r.source)
        for g in {(r.lang, r.source), (r.lang,), ()}:
            groups[g].append(x)
    known = {}
    cutoff = math.sqrt(quality_rules.chi2_quantile(quality_rules.TAIL, quality_rules.P))
    got = {r.doc_id: r for r in queries.quality_outliers(spark, sf).collect()}
    assert len(got) == len(docs)
    assert {d for d, r in got.items() if not r.base_failed} == set(passed)
    rejected = 0
    for d, (n, x, lang, source) in passed.items():
        g = next(g for g in ((lang, source), (lang,), ()) if not g or len(groups[g]) >= quality_rules.MIN_GROUP)
        if g not in known:
            known[g] = plain_estimate(np.array(groups[g], float))
        away = np.array(x) - known[g][0]
        distance = math.sqrt(away @ known[g][1] @ away * n / (n + quality_rules.HALF_WORDS))
        assert abs(got[d].distance - distance) <= 1e-6 * max(1, distance)
        assert got[d].kept == (distance <= cutoff)
        rejected += not got[d].kept
    assert 0 < rejected < len(passed) / 4
