"""Helpers to build landed rows by hand."""

import datetime
import json

from vacantia import schemas

AT = datetime.datetime(2017, 2, 10, 8, 30, 0, 250000)
LATER = datetime.datetime(2017, 2, 10, 9, 0, 0)


def page(source, body, term_no=0, page=0, pos=0, url="https://host.example/list?q=1"):
    if not isinstance(body, str):
        body = json.dumps(body, ensure_ascii=False)
    return (source, "list", f"term {term_no}", term_no, page, pos, None, url, AT, body)


def detail(source, list_id, body, url="https://host.example/dir/detail?id=1", at=LATER):
    if not isinstance(body, str):
        body = json.dumps(body, ensure_ascii=False)
    return (source, "detail", None, None, 0, 0, list_id, url, at, body)


def landed(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW)


def rows_by(df, key):
    return {r[key]: r for r in df.collect()}
