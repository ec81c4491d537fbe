import random

import pytest
from conftest import SF_SMALL, same_rows

from lading.operators.objects import write_bytes
from lading.operators.sink import write_files
from lading.plans.tables import ddl
from lading.sources import ranges
from lading.sources.files import read_files

TRICKY = """<?xml version="1.0"?>
<!-- <row a="no"><v>0</v></row> -->
<rows><rowset/><row a="1"><v>é 1</v></row><row a="x>y"/><!-- -- > <row> -->
<row a="2"><v><![CDATA[</row><row>]]></v></row>
<row a='3'><v>outer</v><row a="4"><v>inner</v></row></row>  <row
 a="5"><v>a &lt; b</v></row><![CDATA[<row>]]><rowx><v>no</v></rowx><row a="6"><v>""" + "long " * 60 + """</v></row></rows>
"""


def records(spark, workdir, text, tag, size):
    write_bytes(f"{workdir}/x/one.xml", text.encode())
    return sorted(r.record for r in ranges.xml_records(spark, f"{workdir}/x", tag, size).collect())


@pytest.mark.parametrize("size", [1, 2, 3, 7, 16, 61, 10_000])
def test_xml_records_wherever_ranges_meet(spark, workdir, size):
    data = TRICKY if size > 2 else TRICKY[:420] + "</v></row></rows>"
    whole = records(spark, f"{workdir}/whole", data, "row", 1 << 20)
    assert records(spark, f"{workdir}/cut", data, "row", size) == whole
    if size > 2:
        assert [r for r in whole if 'a="2"' in r] == ['<row a="2"><v><![CDATA[</row><row>]]></v></row>']
        assert [r for r in whole if "outer" in r] == ["""<row a='3'><v>outer</v><row a="4"><v>inner</v></row></row>"""]
        assert len(whole) == 6 and '<row a="x>y"/>' in whole


def test_one_xml_file_is_read_by_many_tasks(spark, workdir):
    src = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    write_files(src, f"{workdir}/one.xml", "xml", single_file=True, rowTag="row", rootTag="rows")
    got = ranges.read_xml_ranges(spark, f"{workdir}/one.xml", ddl(src), "row", range_bytes=200_000)
    assert got.rdd.getNumPartitions() > 4 and got.count() == src.count()
    assert same_rows(got, read_files(spark, f"{workdir}/one.xml", "xml", ddl(src), rowTag="row"))
    assert same_rows(got, src)
    with pytest.raises(ValueError):
        ranges.read_xml_ranges(spark, f"{workdir}/one.xml", ddl(src), "row", encoding="UTF-16")


@pytest.mark.parametrize("size", [1, 5, 33, 1 << 20])
def test_csv_records_wherever_ranges_meet(spark, workdir, size):
    rng = random.Random(size)
    word = lambda: rng.choice(["a", "é", 'say "x"', "two\nlines", "\n", ",", "", "cr\r\nlf", '""', '\n"'])
    rows = [(i, word(), word()) for i in range(60)]
    text = "id,x,y\n" + "".join(f"{i}," + ",".join('"' + v.replace('"', '""') + '"' for v in r) + rng.choice(["\n", "\r\n"])
                                for i, *r in rows)
    write_bytes(f"{workdir}/c/one.csv", text.encode())
    write_bytes(f"{workdir}/c/two.csv", b'id,x,y\n100,"last\n",without a feed')
    schema = "id int, x string, y string"
    got = ranges.read_csv_ranges(spark, f"{workdir}/c", schema, range_bytes=size, escape='"', emptyValue="", nullValue="\\N")
    want = rows + [(100, "last\n", "without a feed")]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_one_csv_file_with_line_feeds_in_quotes(spark, workdir):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    write_files(docs, f"{workdir}/one.csv", "csv", single_file=True, escape='"')
    got = ranges.read_csv_ranges(spark, f"{workdir}/one.csv", docs.schema, range_bytes=50_000, escape='"')
    assert got.rdd.getNumPartitions() > 4
    assert same_rows(got, docs)
    assert same_rows(got, read_files(spark, f"{workdir}/one.csv", "csv", docs.schema, escape='"', multiLine="true"))
    with pytest.raises(ValueError):
        ranges.read_csv_ranges(spark, f"{workdir}/one.csv", docs.schema)
