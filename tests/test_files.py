import csv
import datetime
import glob
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from vacantia import fixed, schemas, session
from vacantia.operators import heat
from vacantia.sources import files, sinks, stored

LISTINGS = [("Needs", ["a \"b\"", "c, d", "é\ne"]), ("None", [])]


def posting(job_id, **changes):
    row = dict.fromkeys(schemas.STORED_POSTING.names) | {
        "source": "s", "list_id": job_id, "job_id": job_id, "title": ' "T", x ',
        "date_posted": datetime.date(2017, 2, 9),
        "time_scraped": datetime.datetime(2017, 2, 10, 8, 30, 0, 250000),
        "role_description": 'line "1"\nline 2,\r\n\\end', "listings": LISTINGS,
    } | changes
    return tuple(row[c] for c in schemas.STORED_POSTING.names)


def postings(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.STORED_POSTING)


def raw_rows(path):
    """The CSV as another tool reads it: one header per part."""
    rows = []
    for part in sorted(glob.glob(f"{path}/*.csv")):
        with open(part, encoding="utf8", newline="") as f:
            header, *body = csv.reader(f)
        rows += [dict(zip(header, r)) for r in body]
    return rows


def test_posting_csv(spark, tmp_path):
    path = str(tmp_path / "direct")
    rows = postings(spark, posting("1"), posting(
        "2", date_posted=None, date_posted_raw="soon", listings=[],
        time_scraped=datetime.datetime(2017, 2, 10, 8, 30)))
    sinks.export_postings(rows.coalesce(1), path, "overwrite")
    first, second = sorted(raw_rows(path), key=lambda r: r["job_id"])
    assert list(first) == fixed.JOB_COLUMNS
    assert first["title"] == ' "T", x '
    assert first["role_description"] == 'line "1"\nline 2,\r\n\\end'
    assert first["department"] == "" and first["date_posted"] == "2017-02-09"
    assert first["time_scraped"] == "2017-02-10 08:30:00.250000"
    assert json.loads(first["listings"]) == [{"type": t, "elements": e} for t, e in LISTINGS]
    assert (second["date_posted"], second["time_scraped"]) == ("soon", "2017-02-10 08:30:00")
    assert second["listings"] == "[]"


def test_posting_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "agg")
    rows = [posting("1", company="C", original_url="u"), posting("2", date_posted=None,
                                                                 date_posted_raw="soon")]
    sinks.export_aggregator_postings(postings(spark, rows[0]), path)
    sinks.export_aggregator_postings(postings(spark, rows[1]), path)
    back = stored.read_postings(spark, path, aggregator=True)
    assert [f.dataType for f in back.select(*fixed.AGGREGATOR_COLUMNS).schema] == [
        f.dataType for f in schemas.AGGREGATOR_POSTING]
    got = {r.job_id: r for r in back.collect()}
    assert got["1"].role_description == 'line "1"\nline 2,\r\n\\end'
    assert [(s.type, s.elements) for s in got["1"].listings] == LISTINGS
    assert (got["1"].company, got["1"].original_url, got["1"].title) == ("C", "u", ' "T", x ')
    assert got["1"].time_scraped == datetime.datetime(2017, 2, 10, 8, 30, 0, 250000)
    assert (got["2"].date_posted, got["2"].date_posted_raw) == (None, "soon")


def test_overwrite_and_append(spark, tmp_path):
    path = str(tmp_path / "modes")
    one = postings(spark, posting("1"))
    for mode, n in (("overwrite", 1), ("append", 2), ("append", 3), ("overwrite", 1)):
        sinks.export_postings(one, path, mode)
        assert len(raw_rows(path)) == n


def test_company_csv(spark, tmp_path):
    path = str(tmp_path / "companies")
    row = {c: f"v {c}" for c in schemas.COMPANY_COLUMNS} | {"ceo": None}
    df = spark.createDataFrame([tuple(row[c] for c in schemas.COMPANY_COLUMNS)], schemas.COMPANY)
    sinks.export_companies(df, path)
    sinks.export_companies(df, path)
    assert raw_rows(path) == [row | {"ceo": ""}]


def test_seen_ids(spark, tmp_path):
    path = str(tmp_path / "ids")
    assert stored.read_seen(spark, path, "s").collect() == []
    stored.append_seen(postings(spark, posting("1"), posting(None)), path)
    stored.append_seen(postings(spark, posting(" 2\t"), posting("1")), path)
    assert sorted(tuple(r) for r in stored.read_seen(spark, path, "s").collect()) == [
        ("s", "1"), ("s", "2")]


def test_site_files(spark, tmp_path):
    path = tmp_path / "sites.csv"
    path.write_text('longitude,note,company,latitude\n2.5,"a, ""b""",apple,1\nNA,,apple,1\n,x,NA,y\n')
    rows = stored.read_sites(spark, str(path), "company").collect()
    assert [tuple(r) for r in rows] == [("apple", 1.0, 2.5), ("apple", 1.0, None), (None, None, None)]
    path = tmp_path / "aggregator.csv"
    path.write_text("date_posted,latitude,longitude\n2017-02-09,1,2\n2017-02-01 10:00,1,2\nNA,1,2\n,3,4\n")
    sites = stored.read_sites(spark, str(path), "aggregator")
    assert sites.schema == schemas.AGGREGATOR_SITE
    counts = {(r.week, r.latitude): r.quantity for r in heat.week_counts(sites).collect()}
    assert counts == {(0, 1.0): 1, (1, 1.0): 1, (None, 1.0): 1, (None, 3.0): 1}


def test_filled_keeps_order_and_fills(spark):
    df = spark.createDataFrame([(1, None)], "a int, `b-c` string")
    made = sinks.filled(df, ["b-c", "missing", "a"])
    assert made.columns == ["b-c", "missing", "a"]
    assert tuple(made.first()) == ("", "", "1")
    assert made.select(F.col("`b-c`")).first()[0] == ""


def test_a_write_that_fails_leaves_the_earlier_file(spark, tmp_path):
    path = str(tmp_path / "direct")
    sinks.export_postings(postings(spark, posting("1")), path, "overwrite")
    broken = postings(spark, posting("2"), posting("3")).withColumn("title", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        sinks.export_postings(broken, path, "overwrite")
    assert [r.job_id for r in stored.read_postings(spark, path).collect()] == ["1"]
    sinks.export_postings(postings(spark, posting("4")), path, "overwrite")
    assert [r.job_id for r in stored.read_postings(spark, path).collect()] == ["4"]
    assert not (tmp_path / "direct-before").exists()


def test_a_swap_that_was_lost_half_way_is_taken_back(spark, tmp_path):
    path = str(tmp_path / "direct")
    sinks.export_postings(postings(spark, posting("1")), path, "overwrite")
    (tmp_path / "direct").rename(tmp_path / "direct-before")
    files.restore(spark, path)
    assert [r.job_id for r in stored.read_postings(spark, path).collect()] == ["1"]


def test_exports_are_cut_into_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "FILE_ROWS", 2)
    path = str(tmp_path / "direct")
    sinks.export_postings(postings(spark, *(posting(str(i)) for i in range(5))).coalesce(1), path)
    assert len(glob.glob(f"{path}/*.csv")) == 3
    assert sorted(r.job_id for r in stored.read_postings(spark, path).collect()) == list("01234")


def test_work_folders_are_shared_and_removed(spark, tmp_path):
    first = session.work_dir(spark, "one")
    spark.range(3).write.parquet(first)
    assert spark.read.parquet(first).count() == 3 and first.startswith(spark.conf.get("spark.checkpoint.dir"))
    session.clean(spark)
    assert files.folders(spark, first) == [] and not pathlib.Path(first).exists()

    class Elsewhere:
        class conf:
            get = staticmethod(lambda key, *default: default[0] if default else "file:/home/warehouse")

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="share"):
        session.work_dir(Elsewhere, "two")
