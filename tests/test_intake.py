"""Intake: deliveries stay whole, known contents are not landed twice, replays are harmless."""

import os
import time

import golden
import pytest
from pyspark.sql import functions as F

from tariffbook.schemas import RAW_PLANS
from tariffbook.sources.files import read_csv, read_csv_by_name
from tariffbook.sources.manifest import expected_files, listing, missing_inputs, require_inputs
from tariffbook.streaming import intake

HEADER, *LINES = golden.PLANS.strip().splitlines()


TABLES = {"plans": RAW_PLANS}


def write(folder, name, lines, header=HEADER, days_ago=0):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")
    when = time.time() - 86400 * days_ago
    os.utime(folder / name, (when, when))


@pytest.fixture
def place(spark, tmp_path):
    source, landing = tmp_path / "source", str(tmp_path / "landing")

    def take_in():
        intake.ingest(spark, str(source), landing, TABLES)
        rows = [tuple(r) for r in intake.current(spark, landing, "plans", RAW_PLANS).collect()]
        entries = intake.read_ledger(spark, landing).collect()
        states = {"/".join(e.path.split("/")[-2:]): (e.number, e.state, e.rows) for e in entries}
        return sorted(rows, key=str), states

    return source, take_in


def parsed(lines):
    return sorted((tuple(v or None for v in line.split(",")) for line in lines), key=str)


def test_waiting_deliveries_do_not_mix(place):
    source, take_in = place
    write(source / "1", "plans.csv", LINES[:12], days_ago=2)
    write(source / "2", "plans.csv", LINES[3:], days_ago=1)
    rows, states = take_in()
    assert rows == parsed(LINES[3:])
    assert states == {"1/plans.csv": (0, "landed", 12), "2/plans.csv": (1, "landed", len(LINES) - 3)}
    assert take_in() == (rows, states)


def test_an_unchanged_part_stays(place):
    source, take_in = place
    write(source / "1", "plans-1.csv", LINES[:5], days_ago=2)
    write(source / "1", "plans-2.csv", LINES[5:9], days_ago=2)
    take_in()
    write(source / "2", "plans-1.csv", LINES[:5], days_ago=1)
    write(source / "2", "plans-2.csv", LINES[5:12], days_ago=1)
    rows, states = take_in()
    assert rows == parsed(LINES[:12])
    assert states["2/plans-1.csv"] == (1, "known", 5)


def test_a_rollback_counts(place):
    source, take_in = place
    for number, lines in enumerate((LINES[:9], LINES[4:], LINES[:9])):
        write(source / str(number), "plans.csv", lines, days_ago=9 - number)
        rows, states = take_in()
        assert rows == parsed(lines)
    assert [s[1] for s in states.values()].count("known") == 1


def test_neither_age_nor_number_of_files_loses_rows(place):
    source, take_in = place
    write(source / "1", "plans.csv", LINES[:3], days_ago=1)
    take_in()
    for i, line in enumerate(LINES):
        write(source / "2", f"plans-{i:02}.csv", [line], days_ago=400)
    _, states = take_in()
    assert len(states) == 1 + len(LINES)
    assert all(state in ("landed", "known") for _, state, _ in states.values())
    write(source / "3", "plans.csv", LINES[:4], days_ago=30)
    rows, _ = take_in()
    assert rows == parsed(LINES[:4])


def test_other_column_order_in_a_later_delivery(place):
    source, take_in = place
    write(source / "1", "plans.csv", LINES[:3], days_ago=2)
    take_in()
    header = "end_date,note,plan_id,effective_date,price_per_month,plan_tier"
    write(source / "2", "plans.csv", [",x,P1,1/1/2024,9.99,Basic"], header, days_ago=1)
    rows, _ = take_in()
    assert rows == [("P1", "Basic", "9.99", "1/1/2024", None)]


def test_an_unreadable_file_is_set_aside(place):
    source, take_in = place
    write(source / "1", "plans.csv", LINES[:3], days_ago=3)
    before, _ = take_in()
    write(source / "2", "plans.csv", ["1,2"], "other,columns", days_ago=2)
    rows, states = take_in()
    assert rows == before
    assert states["2/plans.csv"] == (1, "unreadable", None)
    write(source / "3", "plans.csv", LINES[:6], days_ago=1)
    rows, _ = take_in()
    assert rows == parsed(LINES[:6])


def test_an_empty_file_is_an_empty_table(place):
    source, take_in = place
    write(source / "1", "plans.csv", LINES[:3], days_ago=2)
    take_in()
    write(source / "2", "plans.csv", [], days_ago=1)
    rows, states = take_in()
    assert (rows, states["2/plans.csv"]) == ([], (1, "empty", 0))


def test_each_delivery_must_be_complete(spark, tmp_path):
    both = {**TABLES, "others": RAW_PLANS}
    write(tmp_path / "1", "plans.csv", LINES[:3], days_ago=2)
    write(tmp_path / "1", "others.csv", LINES[:3], days_ago=2)
    intake.ingest(spark, str(tmp_path), str(tmp_path / "landing"), both)
    write(tmp_path / "2", "plans.csv", LINES[:4], days_ago=1)
    with pytest.raises(FileNotFoundError, match="others.csv"):
        intake.ingest(spark, str(tmp_path), str(tmp_path / "landing"), both)
    assert intake.current(spark, str(tmp_path / "landing"), "plans", RAW_PLANS).count() == 3


def test_a_delivery_taken_in_twice_ends_the_same(spark, tmp_path):
    write(tmp_path / "1", "plans.csv", LINES[:5])
    files = intake.pending(spark, str(tmp_path), str(tmp_path / "landing"), TABLES)[0]
    for _ in range(2):
        intake.take_in(spark, files, str(tmp_path / "landing"), TABLES, 0)
    assert intake.current(spark, str(tmp_path / "landing"), "plans", RAW_PLANS).count() == 5
    assert intake.read_ledger(spark, str(tmp_path / "landing")).count() == 1


def test_digest_ignores_row_order_but_not_content(spark):
    def digest(rows):
        df = spark.createDataFrame(rows, "a string, b string").withColumn("path", F.lit("p"))
        return intake.file_digests(df).first().content_md5

    rows = [("x", "y"), ("x", None), ("", "xy")]
    assert digest(rows) == digest(rows[::-1])
    changed = [
        [("x", "y"), ("x", ""), ("", "xy")],
        [("x", "y"), ("x", None), ("x", "y")],
        [("xy", ""), ("x", None), ("", "xy")],
        rows + rows[:1],
    ]
    assert len({digest(r) for r in [rows, *changed]}) == 5


def test_header_must_match_the_schema(spark, tmp_path):
    swapped = HEADER.replace("plan_id,plan_tier", "plan_tier,plan_id")
    (tmp_path / "plans.csv").write_text("\n".join([swapped, *LINES]))
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv(spark, str(tmp_path / "plans.csv"), RAW_PLANS).collect()


def test_columns_found_by_name(spark, tmp_path):
    lines = ["end_date,note,plan_id,effective_date,price_per_month,plan_tier", ",x,P1,1/1/2024,9.99,Basic"]
    (tmp_path / "plans.csv").write_text("\n".join(lines))
    df = read_csv_by_name(spark, str(tmp_path), RAW_PLANS)
    assert [tuple(r) for r in df.collect()] == [("P1", "Basic", "9.99", "1/1/2024", None)]
    (tmp_path / "plans2.csv").write_text("\n".join([HEADER, *LINES]))
    with pytest.raises(Exception, match="CSV header"):
        read_csv_by_name(spark, str(tmp_path), RAW_PLANS).collect()


def test_raw_columns_are_text(spark, tmp_path):
    (tmp_path / "plans.csv").write_text(golden.PLANS)
    df = read_csv(spark, str(tmp_path / "plans.csv"), RAW_PLANS)
    assert set(dict(df.dtypes).values()) == {"string"}
    assert df.count() == 22
    assert df.filter("price_per_month IS NULL").count() == 1


def test_manifest(spark, tmp_path):
    (tmp_path / "plans.csv").write_text(golden.PLANS)
    present = listing(spark, str(tmp_path))
    row = present.first()
    assert (row.file_name, row.length) == ("plans.csv", len(golden.PLANS))
    missing = missing_inputs(expected_files(spark), present)
    assert sorted(r.file_name for r in missing.collect()) == ["subscribers.csv", "subscriptions.csv"]
    require_inputs(spark, str(tmp_path), ["plans.csv"])


def jobs_of(spark, work):
    """How many Spark jobs ``work`` takes."""
    context = spark.sparkContext
    context.setJobGroup("counted", "counted")
    try:
        work()
        return len(context.statusTracker().getJobIdsForGroup("counted"))
    finally:
        context.setJobGroup("other", "other")


def test_jobs_do_not_grow_with_files(spark, tmp_path):
    taken = {}
    for files in (12, 1200):
        source, landing = tmp_path / f"source{files}", str(tmp_path / f"landing{files}")
        for i in range(files):
            flipped = ",".join(reversed(HEADER.split(",")))
            line = [str(i), "Basic", "9.99", "1/1/2024", ""]
            pick = i % 3 == 1
            write(source / "1", f"plans-{i:04}.csv", [",".join(line[::-1] if pick else line)], flipped if pick else HEADER)
        if files == 1200:
            (source / "2").mkdir()
            write(source / "2", "plans-a.csv", LINES, days_ago=-1)
            write(source / "2", "plans-b.csv", LINES, days_ago=-1)
        taken[files] = jobs_of(spark, lambda: intake.ingest(spark, str(source), landing, TABLES))
    assert taken[1200] <= taken[12] + 30 <= 70
    states = {r["state"]: r["count"] for r in intake.read_ledger(spark, landing).groupBy("state").count().collect()}
    assert states == {"landed": 1201, "known": 1}
    ids = spark.read.parquet(f"{landing}/plans").where("kind = 'record'").select("plan_id")
    assert ids.where("plan_id RLIKE '^[0-9]+$'").distinct().count() == 1200
    rows = intake.current(spark, landing, "plans", RAW_PLANS).collect()
    assert sorted(map(tuple, rows), key=str) == parsed(LINES)


def test_reordered_or_extended_files_are_new_contents(place):
    source, take_in = place
    write(source / "1", "plans.csv", LINES, days_ago=3)
    take_in()
    write(source / "2", "plans.csv", LINES[::-1], days_ago=2)
    rows, states = take_in()
    assert (rows, states["2/plans.csv"]) == (parsed(LINES), (1, "landed", len(LINES)))
    write(source / "3", "plans.csv", [f"{line},x" for line in LINES], f"{HEADER},note", days_ago=1)
    rows, states = take_in()
    assert (rows, states["3/plans.csv"]) == (parsed(LINES), (2, "landed", len(LINES)))
    write(source / "4", "plans.csv", LINES[::-1], days_ago=0)
    rows, states = take_in()
    assert (rows, states["4/plans.csv"]) == (parsed(LINES), (3, "known", len(LINES)))


def test_lines_that_are_no_records_are_kept_apart(spark, tmp_path):
    """Records, bad lines, blanks and the header are all lines of the file."""
    bad = {4: "P9,a", 7: "P9,a,1,2,3,4,5", 8: '"P9,a,1,2,3', 12: "P9"}
    body = [bad.get(n, "" if n == 5 else LINES[n]) for n in range(2, 16)]
    write(tmp_path / "1", "plans.csv", body, days_ago=1)
    write(tmp_path / "1", "plans-2.csv", LINES[:3], days_ago=1)
    landing = str(tmp_path / "landing")
    intake.ingest(spark, str(tmp_path), landing, TABLES)
    found = {(r["path"].rsplit("/", 1)[1], r["line"]): (r["reason"], r["raw"]) for r in intake.bad_lines(spark, landing, "plans").collect()}
    assert found == {
        ("plans.csv", 4): ("too_few_fields", bad[4]), ("plans.csv", 7): ("too_many_fields", bad[7]),
        ("plans.csv", 8): ("open_quote", bad[8]), ("plans.csv", 12): ("too_few_fields", bad[12]),
    }
    ledger = {e["path"].rsplit("/", 1)[1]: (e["rows"], e["bad"], e["state"]) for e in intake.read_ledger(spark, landing).collect()}
    assert ledger == {"plans.csv": (9, 4, "landed"), "plans-2.csv": (3, 0, "landed")}
    assert 1 + 9 + 4 + 1 == len((tmp_path / "1" / "plans.csv").read_text().splitlines())
    good = [line for n, line in enumerate(body, 2) if n not in bad and line] + LINES[:3]
    assert sorted(map(tuple, intake.current(spark, landing, "plans", RAW_PLANS).collect()), key=str) == parsed(good)


def test_a_killed_intake_is_taken_up_again(spark, tmp_path, monkeypatch):
    """Lines landed but no ledger: nothing is current, and the next try ends as an undisturbed one."""
    write(tmp_path / "1", "plans.csv", LINES[:9], days_ago=1)
    landing = str(tmp_path / "landing")
    with monkeypatch.context() as patched:
        patched.setattr(intake, "_counted", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            intake.ingest(spark, str(tmp_path), landing, TABLES)
    assert intake.current(spark, landing, "plans", RAW_PLANS).isEmpty()
    intake.ingest(spark, str(tmp_path), landing, TABLES)
    assert sorted(map(tuple, intake.current(spark, landing, "plans", RAW_PLANS).collect()), key=str) == parsed(LINES[:9])
