from pyspark.sql import functions as F

from conftest import SF_SMALL, same_rows
from lading.functions.parse import TOKEN_SCHEMA, parse_body, parse_token
from lading.operators.crypto import (decrypt_files, encrypt_files, key_table, mode_of,
                                     read_encrypted, write_encrypted)
from lading.operators.objects import write_bytes
from lading.plans.tables import ddl

KEY = "0123456789abcdef0123456789abcdef"


def test_token_record(spark):
    df = spark.createDataFrame(
        [('{"access_token":"a","token_type":"Bearer","expires_in":3600,"refresh_token":"r"}',)], "b string")
    row = df.select(parse_token("b").alias("t")).first().t
    assert row.asDict() == {"access_token": "a", "token_type": "Bearer", "expires_in": "3600",
                            "refresh_token": "r"}
    assert df.select(parse_token("b").alias("t")).schema["t"].dataType == TOKEN_SCHEMA


def test_parse_body_json_and_other_types(spark):
    df = spark.createDataFrame([('{"a": {"b": [1, 2]}}',), ('{\n "a": {"b": [3]}\n}',)], "body string")
    inferred = parse_body(df, "body")
    assert sorted(r.parsed.a.b for r in inferred.collect()) == [[1, 2], [3]]
    assert parse_body(df, "body", "xml").first().parsed is None


def test_modes():
    assert mode_of("AES") == ("ECB", "PKCS") and mode_of("aes/gcm/nopadding") == ("GCM", "NONE")


def test_key_file_and_plan_has_no_key(spark, workdir):
    write_bytes(f"{workdir}/keys/k.txt", f"old=ffffffffffffffff\nnew={KEY}\n".encode())
    keys = {r.key_id: bytes(r.key) for r in key_table(spark, f"{workdir}/keys").collect()}
    assert keys == {"old": b"f" * 16, "new": KEY.encode()}
    write_bytes(f"{workdir}/plain/a.json", b'{"x": 1}\n{"x": 2}\n')
    manifest = encrypt_files(spark, f"{workdir}/plain", f"{workdir}/enc", f"{workdir}/keys", key_id="new")
    assert manifest.first().staged_path.endswith("a.json.enc")
    ciphertext = spark.read.format("binaryFile").load(f"{workdir}/enc").first().content
    assert b'"x"' not in bytes(ciphertext)
    df = read_encrypted(spark, f"{workdir}/enc", "json", f"{workdir}/keys", schema="x int", key_id="new")
    assert sorted(r.x for r in df.collect()) == [1, 2]


def test_encrypted_delivery_round_trip(spark, workdir):
    write_bytes(f"{workdir}/key", KEY.encode())
    src = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    for algo in ("AES", "AES/CBC/PKCS5Padding", "AES/GCM/NoPadding"):
        target = f"{workdir}/{algo.replace('/', '_')}"
        write_encrypted(src, target, "parquet", f"{workdir}/key", algorithm=algo)
        back = read_encrypted(spark, target, "parquet", f"{workdir}/key", algorithm=algo)
        assert same_rows(src, back)


def test_decrypt_only(spark, workdir):
    write_bytes(f"{workdir}/key", KEY.encode())
    write_bytes(f"{workdir}/p/one.txt", b"hello")
    encrypt_files(spark, f"{workdir}/p", f"{workdir}/e", f"{workdir}/key")
    m = decrypt_files(spark, f"{workdir}/e", f"{workdir}/d", f"{workdir}/key")
    assert m.first().staged_path.endswith("/one.txt")
    assert spark.read.text(f"{workdir}/d").first().value == "hello"


def test_key_stays_out_of_the_plan_and_duplicates_fail(spark, workdir):
    import pytest
    from pyspark.sql import functions as F

    write_bytes(f"{workdir}/key", KEY.encode())
    files = spark.read.format("binaryFile").load(f"{workdir}/key")
    key = key_table(spark, f"{workdir}/key").filter(F.col("key_id") == "default").select("key").scalar()
    enc = files.select(F.aes_encrypt("content", key).alias("e"))
    enc.collect()
    assert KEY not in enc._jdf.queryExecution().toString()
    assert "BroadcastNestedLoopJoin" not in enc._jdf.queryExecution().toString()
    write_bytes(f"{workdir}/dup", f"a={KEY}\na={KEY}\n".encode())
    write_bytes(f"{workdir}/p/x.txt", b"x")
    with pytest.raises(Exception):
        encrypt_files(spark, f"{workdir}/p", f"{workdir}/e", f"{workdir}/dup", key_id="a")


def test_crypto_options_on_reader_and_writer(spark, workdir):
    from lading.operators.sink import Writer
    from lading.sources.files import Reader

    src = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    (Writer(src).option("fileType", "csv").option("cryptoKey", KEY)
     .option("cryptoAlgorithm", "AES/CBC/PKCS5Padding").save(f"{workdir}/enc"))
    raw = spark.read.format("binaryFile").load(f"{workdir}/enc").collect()
    assert raw and all(b"ALGERIA" not in bytes(r.content) for r in raw)
    back = (Reader(spark).option("fileType", "csv").option("cryptoKey", KEY)
            .option("cryptoAlgorithm", "AES/CBC/PKCS5Padding").schema(ddl(src)).load(f"{workdir}/enc"))
    assert same_rows(src, back)


def test_single_file_encrypted_delivery(spark, workdir):
    from lading.operators.sink import Writer
    from lading.sources.files import Reader

    src = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    target = f"{workdir}/out/orders.csv"
    (Writer(src).option("fileType", "csv").option("singleFile", "true")
     .option("cryptoKey", KEY).save(target))
    listed = spark.read.format("binaryFile").load(f"{workdir}/out").collect()
    assert [r.path.rsplit("/", 1)[1] for r in listed] == ["orders.csv"]
    back = (Reader(spark).option("fileType", "csv").option("cryptoKey", KEY)
            .schema(ddl(src)).load(target))
    assert same_rows(src, back)


def test_unlike_bodies(spark):
    from lading.functions.parse import parse_unlike, unlike_schema

    bodies = ['{"k":1}', '[{"k":2}]', '"x"', '{"k": ', "<r><k>5</k></r>", " <r><k>5</r>", "", "  ", None, "null",
              '<?xml version="1.0"?>\n<r a="1"><k>7</k><b>u</b></r>', "hello", '{"k":"one","b":null}', '{"k":1}{"k":2}', "1,2", "1]", "1}", '1,"a":2', ' {"k":1}\n ']
    df = spark.createDataFrame(list(enumerate(bodies)), "id int, `the body` string")
    kinds = ["json", "json", "json", "malformed", "xml", "malformed", "empty", "empty", "empty", "json", "xml", "malformed", "json", *["malformed"] * 5, "json"]
    got = parse_unlike(df, "the body", "k long, b string")
    rows = sorted(got.select("id", "parsed_kind", F.to_json("parsed").alias("v"), "the body").collect())
    assert [r.parsed_kind for r in rows] == kinds and [r["the body"] for r in rows] == bodies
    assert [r.v for r in rows if r.parsed_kind == "xml"] == ['{"b":null,"k":5}', '{"b":"u","k":7}']
    assert all((r.v is None) == (r.parsed_kind in ("empty", "malformed")) for r in rows)
    assert unlike_schema(got.where("id IN (0, 4)")).startswith("OBJECT<")
    assert unlike_schema(got) == "VARIANT" and unlike_schema(got.limit(0)) == "VOID"
    without = parse_unlike(df, "the body")
    assert {r.id for r in without.where("parsed_kind = 'xml' AND parsed IS NULL").collect()} == {4, 5, 10}
