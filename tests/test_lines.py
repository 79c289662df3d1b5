"""Files as lines: digests that follow contents and nothing else, records by name, lines that are none."""

import random

import pytest
from pyspark.sql import functions as F

from tariffbook.schemas import RAW_PLANS
from tariffbook.sources import lines
from tariffbook.sources.manifest import listing

HEADER = "plan_id,plan_tier,price_per_month,effective_date,end_date"


def digests(spark, folder, **settings):
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        files = sorted(folder.glob("*.csv"))
        read = lines.read_lines(spark, [str(f) for f in files])
        lengths = listing(spark, str(folder), "*.csv").selectExpr("scan_path AS path", "length")
        rows = lines.file_contents(read, lengths).collect()
        return {r["path"].rsplit("/", 1)[1]: (r["content_md5"], r["lines"], r["header"]) for r in rows}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_digest_is_that_of_the_content(spark, tmp_path):
    pick = random.Random(1)
    body = [f"P{i},{pick.random()},x" for i in range(3000)]
    swapped = [*body[:10], body[11], body[10], *body[12:]]
    contents = {
        "a": body, "same": body, "order": swapped, "reversed": body[::-1], "longer": [*body, "P"], "more": [*body, "", ""],
        "twice": [*body, body[-1]], "field": [*body[:-1], body[-1] + ",note"], "moved": [body[-1], *body[:-1]],
        "rounds": [body[1], body[2], body[0], *body[3:]],
    }
    for name, rows in contents.items():
        (tmp_path / f"{name}.csv").write_text("\n".join([HEADER, *rows]))
    (tmp_path / "crlf.csv").write_bytes("\r\n".join([HEADER, *body]).encode())
    (tmp_path / "ended.csv").write_text("\n".join([HEADER, *body]) + "\n")
    (tmp_path / "bom.csv").write_bytes(b"\xef\xbb\xbf\n  \n" + HEADER.encode() + b"\n")
    found = digests(spark, tmp_path)
    assert found["a.csv"] == found["same.csv"]
    assert len({md5 for md5, _, _ in found.values()}) == len(found) - 1
    assert found["a.csv"][1:] == (3001, HEADER)
    assert found["bom.csv"][1:] == (3, HEADER)
    # Small parts, some of them in one task, some alone.
    small = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "512"}
    assert digests(spark, tmp_path, **small) == found
    assert digests(spark, tmp_path, **small | {"spark.sql.files.maxPartitionBytes": "7001"}) == found


def test_line_numbers_hold_across_parts(spark, tmp_path):
    file = tmp_path / "f.csv"
    file.write_text("\n".join(f"line {i}" for i in range(1, 2001)))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        read = lines.read_lines(spark, [str(file)]).cache()
        assert read.select("block").distinct().count() > 10
        some = lines.numbered(read.where(F.col("value").endswith("7")), read, "path").collect()
        assert {r["value"]: r["line"] for r in some} == {f"line {i}": i for i in range(7, 2001, 10)}
        read.unpersist()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize(
    ("line", "kind", "plan"),
    [
        ("P1,a,1,2,3", "record", "P1"),
        ("P1,a,1,2,", "record", "P1"),
        (",,,,", "record", None),
        ('"P,1",a,"1",2,""', "record", "P,1"),
        (r'"P \"1\",",a,1,2,3', "record", 'P "1",'),
        ('P"1,5" pipe,1,2,3', "record", 'P"1'),
        ("P1,a,1,2", "too_few_fields", None),
        ('"P1,a,1",2', "too_few_fields", None),
        ("P1,a,1,2,3,", "too_many_fields", None),
        ('P1,a,"1,2",3,4,5', "too_many_fields", None),
        ('"P1,a,1,2,3', "open_quote", None),
        ('P1,a,1,2,"', "open_quote", None),
        ('P1,a,"1,2,3', "open_quote", None),
        ("", "blank", None),
        (" \t ", "too_few_fields", None),
        ("   ", "blank", None),
        (HEADER, "header", None),
        ("﻿" + HEADER, "header", None),
        ("x" * 200_000, "too_few_fields", None),
        ('"' + r"\"," * 50_000 + '",a,1,2,3', "record", '",' * 50_000),
        ("," * 15_000, "too_many_fields", None),
    ],
)
def test_what_a_line_is(spark, line, kind, plan):
    row = lines.records(spark.createDataFrame([(line,)], "value string"), HEADER, RAW_PLANS).first()
    assert (row["kind"], row["plan_id"]) == (kind, plan)
    assert row["raw"] == (None if kind == "record" else line)


def test_columns_in_any_order_and_case(spark):
    header = "End_Date, note ,PLAN_ID,effective_date,price_per_month,plan_tier,note"
    df = spark.createDataFrame([("e,n,P,d,1,t,m",)], "value string")
    row = lines.records(df, header, RAW_PLANS).select(*RAW_PLANS.names).first()
    assert tuple(row) == ("P", "t", "1", "d", "e")
    assert lines.places("a,b", ["a", "c"]) is None
    assert lines.places("a,A", ["a"]) is None
    assert lines.places(None, ["a"]) is None
