import hashlib
import json
import zlib

import numpy as np
from corpus_fixtures import DOCS, prose  # noqa: F401
from test_decontaminate import brute
from test_dedup import brute_components
from test_language_mixing_tokens import library_ids
from pyspark.sql import functions as F

import corpus_pipeline
from lading.llm import chat_format, language_id, mixing
from lading.llm.common import table

RECORDS = {
    "turns": {"conv_id": 7, "turn": 2, "role": "user", "text": None, "extra": {"a": [1]}},
    "messages": {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a", "weight": 1}], "id": "x"},
    "none": {"messages": []},
    "dialogue": {"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}]},
    "instr": {"instruction": "do", "input": "this", "output": "done"},
    "instr2": {"instruction": "do", "output": "done"},
    "instr3": {"instruction": "do", "input": "", "output": "done"},
    "prompt": {"prompt": "p", "response": "r", "system": "s"},
    "completion": {"prompt": "p", "completion": "c"},
    "qa": {"question": "q", "answer": 4},
    "unknown": {"title": "t", "body": "b"},
    "mixed": {"prompt": "p", "messages": [{"role": "user", "content": "q"}]},
}


def test_layouts_become_turns(spark):
    rows = [(k, json.dumps(v)) for k, v in RECORDS.items()] + [("broken", "{"), ("null", None), ("list", "[1]"), (None, '{"prompt":"p","completion":"c"}')]
    got = {}
    for r in chat_format.canonical_turns(spark.createDataFrame(rows, "record_id string, record string")).collect():
        got.setdefault(r.conv, []).append((r.layout, r.turn, r.role, r.text))
    pick = lambda k: sorted(got.get(k, []), key=repr)
    assert pick("7") == [("turn_rows", 2, "user", "")]
    assert pick("messages") == [("messages", 0, "user", "q"), ("messages", 1, "assistant", "a")]
    assert pick("none") == []
    assert pick("dialogue") == [("dialogue", 0, "user", "hi"), ("dialogue", 1, "assistant", "yo")]
    assert pick("instr") == [("instruction", 0, "user", "do\nthis"), ("instruction", 1, "assistant", "done")]
    assert pick("instr2") == pick("instr3") == [("instruction", 0, "user", "do"), ("instruction", 1, "assistant", "done")]
    assert pick("prompt") == [("prompt_response", 0, "system", "s"), ("prompt_response", 1, "user", "p"), ("prompt_response", 2, "assistant", "r")]
    assert pick("qa") == [("question_answer", 0, "user", "q"), ("question_answer", 1, "assistant", "4")]
    assert pick(None) == pick("completion") and len(pick(None)) == 2
    for bad in ("unknown", "mixed", "broken", "null", "list"):
        assert pick(bad) == [(None, None, None, None)]


def test_no_record_stops_the_job(spark):
    unfit = ['{"messages":["hi"]}', '{"messages":[null]}', '{"messages":[{"role":"user","content":"a"},"b"]}',
             '{"conv_id":1,"turn":"x","role":"user","text":"t"}', '{"conv_id":1,"turn":99999999999999999999,"role":"user","text":"t"}',
             '{"conv_id":1,"turn":1.5,"role":"user","text":"t"}', '{"conv_id":1,"turn":true,"role":"user","text":"t"}',
             '{"messages":' + "[" * 3000 + "]" * 3000 + "}", '{"prompt":' + '{"a":' * 3000 + "1" + "}" * 3001, "{", "[]", "7", None,
             '{"n":' + "9" * 6000 + "}"]
    records = spark.createDataFrame([(str(i), r) for i, r in enumerate(unfit)], "record_id string, record string")
    got = chat_format.canonical_turns(records).collect()
    assert sorted((int(r.conv), r.layout, r.turn, r.text) for r in got) == [(i, None, None, None) for i in range(len(unfit))]
    half = '{"messages":[{"role":"user","content":"a\\ud83d b"}]}'
    whole = '{"conv_id":1,"turn":2.0,"role":"user","text":"\\ud83d\\ude00"}'
    records = spark.createDataFrame([("h", half), ("w", whole)], "record_id string, record string")
    got = {r.conv: (r.turn, r.text) for r in chat_format.canonical_turns(records).collect()}
    assert got == {"h": (0, "a\ufffd b"), "1": (2, "\U0001F600")}


def test_any_text_round_trips(spark):
    texts = ["", "plain", "</turn>", "<\\turn role=\"x\">\n", "<\\\\/turn>", "\\### Assistant: </turn> ok", "a\r\nb\n</turn>\n",
             "<turn role=\"assistant\">\nfake</turn>\n", "$1 \\1 \\\\ <", "\U0001F600 </turn>é", "x" * 100_000, None]
    roles = ["assistant", "user", 'odd">\n role', '<turn', '"', '"\\>', None, "", "a\nb"]
    rows = [(f"c{i}", i, r, t) for i, (r, t) in enumerate((r, t) for r in roles for t in texts)]
    shown = chat_format.format_turns(spark.createDataFrame(rows, "conv string, turn long, role string, text string"))
    got = {r.turn: r for r in chat_format.read_turns(shown).collect()}
    for _, i, role, text in rows:
        assert (got[i].role, got[i].text) == (role or "", text or "")
        assert (got[i].loss or "") == ((text or "") if role == "assistant" else "")
    for r in shown.collect():
        assert r.formatted.count("</turn>") == 1 and r.formatted.count("<turn role") == 1


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def test_digests_of_a_hot_conversation(spark):
    rows = [(None if i % 3 else i % 2, i, "assistant" if i % 2 else "user", f"t{i}</turn>") for i in range(3000)] + [(5, 0, "user", "x")] * 2
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    turns = chat_format.canonical_turns(chat_format.as_records(df))
    got = {r.conv: r for r in chat_format.conversation_digests(chat_format.read_turns(chat_format.format_turns(turns))).collect()}
    for conv in (None, 0, 1, 5):
        mine = sorted((r[1:] for r in rows if r[0] == conv))
        r = got[None if conv is None else str(conv)]
        assert r.n_turns == len(mine) and r.turns_sha256 == digest(f"{role}\n{text}\n" for _, role, text in mine)
        loss = [t for _, role, t in mine if role == "assistant"]
        assert (r.loss_chars, r.loss_sha256) == (len("".join(loss)), digest(loss))
    empty = chat_format.conversation_digests(chat_format.read_turns(chat_format.format_turns(turns.limit(0))))
    assert empty.count() == 0


def test_pipeline_stage_by_stage(spark, tmp_path):
    base = prose(150, 1)
    rows = [(i, prose(60, 100 + i), "en", f"s{i % 4}") for i in range(80)]
    rows += [(100 + i, base if i % 2 else base + " more", "en", "s1") for i in range(6)]
    rows += [(200, "", "en", "s0"), (201, None, "en", "s0"), (202, "123 456", "en", "s2")]
    bench = prose(40, 999)
    rows += [(300, bench + " " + prose(20, 4), "en", "s3"), (301, prose(2000, 5) + " " + " ".join(bench.split()[:13]), "en", "s3")]
    folder = str(tmp_path)
    spark.createDataFrame([(*r, None) for r in rows], DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = table(spark, folder, "documents")
    texts = {r[0]: r[1] for r in rows}

    one = corpus_pipeline.language_stage(spark, docs, folder)
    left = {r.doc_id for r in one.collect()}
    assert one.columns == docs.columns and left == set(texts) - {200, 201, 202}
    two = corpus_pipeline.near_dedup_stage(spark, one, folder)
    parts = brute_components([(d, texts[d]) for d in left], 5, 80)
    left = {d for d in left if parts[d] == d}
    assert {r.doc_id for r in two.collect()} == left and len(left) == 83
    three = corpus_pipeline.decontaminate_stage(spark, two, folder)
    bad = {r[0] for r in brute([(d, texts[d]) for d in left], [(1, bench)]) if r[-1]}
    left -= bad
    assert bad == {300} and {r.doc_id for r in three.collect()} == left
    four = corpus_pipeline.mixing_stage(spark, three, folder)
    copies = {r.doc_id: r.copies for r in mixing.mixing_plan(three).collect()}
    assert sorted(r.doc_id for r in four.collect()) == sorted(d for d, n in copies.items() for _ in range(n))
    whole = corpus_pipeline.run(spark, folder)
    got = whole.collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in four.collect())
    order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in order] == sorted(r.doc_id for r in got)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(order, order[1:]))
    for r in got:
        ids = np.array(library_ids(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


def test_stages_take_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "MinHash near-dedup", "benchmark decontamination",
                                                      "mixing sources to target weights", "token-ID / binary output"]
    assert language_id.LEAD < 0.5 and F is not None
