import glob
import gzip
import hashlib
import io
import random

import pytest
from compare import connect, spark_rows, sql_rows
from pyspark.sql import functions as F

from vacantia.llm import registry, warc

SF = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string"
draw = random.Random(4)


def round_trip(spark, df, folder):
    warc.write_archives(df, f"{folder}/a")
    warc.build_index(spark, f"{folder}/a", f"{folder}/i")
    keys = df.select(warc.url_key(F.col("url")).alias("key"))
    return warc.read_records(warc.lookup(keys, f"{folder}/i"), f"{folder}/a").collect()


def test_query_agrees_with_sql(spark):
    columns, rows = spark_rows(registry.QUERIES["op2_warc"](spark, SF))
    assert (columns, rows) == sql_rows(connect(SF), registry.SQL["op2_warc"])


def test_payloads_survive_and_copies_refer_to_the_smallest_id(spark, tmp_path):
    long, short = "é" * 80, "s" * 99
    rows = [
        (7, "http://B.example.org:80/x y", long), (3, "https://u@b.example.org/x y", long), (9, None, long),
        (4, "http://a.org/\n", short), (5, "http://a.org/\n", short), (1, "", None), (2, "http://a.org", ""),
        (3, "https://u@b.example.org/x y", long), (None, "http://c.org/?q", long), (8, "no address", "x" * 300),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    found = round_trip(spark, df, str(tmp_path))
    assert len(found) == len(rows)
    for row in found:
        text = dict((i, h or "") for i, _, h in rows)[row.page_id]
        assert row.payload_bytes == len(text.encode())
        assert row.payload_digest == hashlib.sha256(text.encode()).hexdigest()
        if text == long and row.page_id != 3:
            assert (row.record_type, row.refers_to, row.payload) == ("revisit", 3, None)
        else:
            assert (row.record_type, row.refers_to, bytes(row.payload)) == ("response", None, text.encode())


def test_archives_are_gzip_members_with_a_record_each(spark, tmp_path):
    rows = [(i, f"http://h{i}.org/", f"page {i} " * 50) for i in range(40)]
    warc.write_archives(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "a"))
    text = b"".join(gzip.open(f).read() for f in glob.glob(str(tmp_path / "a/part-*")))
    assert text.count(b"WARC/1.1\r\n") == 40
    assert text.endswith(b"\r\n\r\n")


def test_a_record_of_more_than_16_megabytes(spark, tmp_path):
    rows = [(1, "http://a.org/", "ab" * 9_000_000), (2, "http://b.org/", "c")]
    found = {r.page_id: r for r in round_trip(spark, spark.createDataFrame(rows, SCHEMA), str(tmp_path))}
    assert found[1].payload_bytes == 18_000_000
    assert bytes(found[2].payload) == b"c"


def test_lookup_over_many_blocks_and_one_hot_address(spark, tmp_path):
    rows = [(i, "http://hot.org/" if i % 3 == 0 else f"http://h.org/{i % 500}", f"<p>{i}") for i in range(3_000)]
    df, folder = spark.createDataFrame(rows, SCHEMA), str(tmp_path)
    warc.write_archives(df, f"{folder}/a")
    warc.build_index(spark, f"{folder}/a", f"{folder}/i")
    assert spark.read.parquet(f"{folder}/i/directory").count() > 5
    asked = spark.createDataFrame([("org,hot)/",), ("org,h)/7",), ("org,h)/zzz",), (None,), ("",)], "key string")
    found = warc.lookup(asked, f"{folder}/i").collect()
    want = sorted(i for i, u, _ in rows if u in ("http://hot.org/", "http://h.org/7"))
    assert sorted(r.page_id for r in found) == want


def test_archives_are_read_as_streams(monkeypatch):
    records = [b"a" * n for n in (0, 1, 50, 3_000, 7)] + [bytes(draw.randrange(256) for _ in range(5_000))]
    records += [b"ab" * 9_000_000, b"last"]  # the first of these ends in an empty member
    data = b"".join(warc._member(r) + b"\0" for r in records)
    for step in (1, 7, 26, 1 << 16):
        monkeypatch.setattr(warc, "STEP", step)
        found = list(warc._members(io.BytesIO(data)))
        assert [r for _, _, r in found] == records
        assert [o for o, _, _ in found][1:] == [o + n for o, n, _ in found][:-1]
        assert sum(n for _, n, _ in found) == len(data)
    with pytest.raises(ValueError):
        list(warc._members(io.BytesIO(data[:-5])))


def test_no_file_is_read_as_one_value(spark, tmp_path):
    rows = [(i, f"http://h{i}.org/", f"page {i} " * 50) for i in range(40)]
    warc.write_archives(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "a"))
    captures = warc.scan(spark, str(tmp_path / "a"))
    assert "content" not in captures._jdf.queryExecution().executedPlan().toString()
    assert captures.count() == 40


def test_empty_table_and_extra_columns(spark, tmp_path):
    df = spark.createDataFrame([], SCHEMA + ", digest string, size string")
    assert round_trip(spark, df, str(tmp_path)) == []
    one = spark.createDataFrame([(1, "http://a.org/", "x", "d", "s")], SCHEMA + ", digest string, size string")
    assert len(round_trip(spark, one, str(tmp_path / "b"))) == 1


def test_control_characters_anywhere_in_an_address(spark, tmp_path):
    marks = ["\n", "\r", "\x7f", "\r\n", " ", "\t", "\x00", "\x85", "\u2028"]
    forms = ["http://exa{}mple.com/", "http://example.com{}", "http://a.org:80{}/x", "http://u{}@a.org/", "http://a.org/{}p?q={}", "{}http://a.org/"]
    forms += ["http://u@a{}b@c.org/", "no address{}", "http://{}", "HTTP://A.Org:80{}"]
    urls = [form.replace("{}", mark) for form in forms for mark in marks] + ["http://exa%0Ample.com/", "http://exa%0ample.com/", "%0A", "", None]
    rows = [(i, u, f"<p>{i}") for i, u in enumerate(urls)]
    found = round_trip(spark, spark.createDataFrame(rows, SCHEMA), str(tmp_path))
    assert sorted(r.page_id for r in found) == list(range(len(urls)))
