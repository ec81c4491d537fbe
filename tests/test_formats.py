import pytest

from lading.sources import formats
from lading.sources.files import read_files
from lading.operators.sink import write_files


def test_whitelist_and_aliases():
    assert formats.file_type("CSV") == "csv"
    assert formats.file_type("application/json") == "json"
    assert formats.file_type("text/plain") == "txt"
    with pytest.raises(ValueError, match="Supported file types are"):
        formats.file_type("orc")
    with pytest.raises(ValueError, match="fileType"):
        formats.file_type(None)


def test_reader_defaults_follow_the_connector():
    opts = formats.read_options("csv", {})
    assert opts["header"] == "true" and opts["delimiter"] == "," and opts["inferSchema"] == "false"
    # user options win, case-insensitively
    opts = formats.read_options("csv", {"HEADER": "false"})
    assert opts["HEADER"] == "false" and "header" not in opts


def test_connector_keys_never_reach_spark():
    opts = formats.read_options("json", {"fileType": "json", "cryptoKey": "k", "password": "p",
                                         "copyLatest": "true", "multiLine": "true"})
    assert set(opts) == {"multiLine"}


def test_staging_aliases():
    assert formats.normalise({"tempLocation": "/a"})["stagingLocation"] == "/a"
    assert formats.normalise({"tempLocation": "/a", "hdfsTempLocation": "/b"})["stagingLocation"] == "/b"


def test_codec_maps_to_compression():
    opts = formats.write_options("csv", {"codec": "gzip"})
    assert opts["compression"] == "gzip" and "codec" not in opts


def test_errors(spark, workdir):
    with pytest.raises(ValueError, match="rowTag"):
        read_files(spark, workdir, "xml")
    with pytest.raises(ValueError, match="path"):
        read_files(spark, [], "csv")
    with pytest.raises(ValueError, match="not supported"):
        write_files(spark.range(1), workdir, "orc")
    with pytest.raises(ValueError, match="save mode"):
        write_files(spark.range(1), workdir, "json", mode="upsert")


def test_remote_uri_and_login_settings():
    from lading.sources.remote import hadoop_settings, remote_uri

    opts = {"host": "files.example", "username": "u", "password": "pw", "pem": "/k.pem"}
    assert remote_uri("/drops/x.csv", opts) == "sftp://u@files.example:22/drops/x.csv"
    assert remote_uri("/a", {"host": "h", "port": "2222", "protocol": "ftp"}) == "ftp://h:2222/a"
    assert remote_uri("hdfs:///a", opts) == "hdfs:///a"
    assert remote_uri("/a", {}) == "/a"
    conf = hadoop_settings(opts)
    assert conf["fs.sftp.password.files.example.u"] == "pw" and conf["fs.sftp.keyfile"] == "/k.pem"
    assert "pw" not in remote_uri("/drops/x.csv", opts)


def test_enforce_schema_false_rejects_misordered_header(spark, workdir):
    import pytest
    from lading.operators.objects import write_bytes

    write_bytes(f"{workdir}/s.csv", b"b,a\n1,2\n")
    ok = read_files(spark, f"{workdir}/s.csv", "csv", schema="a int, b int")
    assert ok.first().a == 1                    # positional: silently shifted
    with pytest.raises(Exception):
        read_files(spark, f"{workdir}/s.csv", "csv", schema="a int, b int", enforceSchema="false").collect()


def test_reader_with_host_targets_the_remote_not_a_local_path(spark, workdir):
    import pytest
    from lading.operators.objects import write_bytes
    from lading.sources.files import Reader

    write_bytes(f"{workdir}/x.csv", b"a\n1\n")     # same path exists locally ...
    with pytest.raises(Exception) as err:           # ... but the remote one is meant
        (Reader(spark).option("host", "files.invalid").option("username", "u")
         .option("fileType", "csv").load(f"{workdir}/x.csv").collect())
    assert "sftp" in str(err.value).lower() or "files.invalid" in str(err.value)


def test_top_level_exports_and_format(spark, workdir):
    from lading import Reader, Writer

    src = spark.read.parquet("/root/testdata/sf0.001/region.parquet")
    Writer(src).format("json").save(f"{workdir}/r")
    assert Reader(spark).format("json").schema(src.schema).load(f"{workdir}/r").count() == 5


def test_options_that_would_not_hold_are_refused():
    with pytest.raises(ValueError, match="pemPassphrase"):
        formats.normalise({"pemPassphrase": "x"})
    with pytest.raises(ValueError, match="multiLine"):
        formats.read_options("xml", {"rowTag": "r", "multiLine": "false"})
