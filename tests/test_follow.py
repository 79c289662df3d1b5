"""Intake as a stream: replays change nothing, neither small batches nor old files lose anything."""

import golden
import pytest
from test_intake import HEADER, LINES, TABLES, parsed, write

from tariffbook.schemas import RAW_PLANS
from tariffbook.streaming import follow, intake


@pytest.fixture
def stream(spark, tmp_path):
    source, landing = tmp_path / "source", str(tmp_path / "landing")
    source.mkdir()

    def run(tables=TABLES, **options):
        query = follow.follow(spark, str(source), landing, tables, str(tmp_path / "checkpoint"), **options)
        query.awaitTermination()
        return state(spark, landing)

    return source, landing, run


def state(spark, landing):
    rows = intake.current(spark, landing, "plans", RAW_PLANS).collect()
    ledger = sorted(tuple(r) for r in intake.read_ledger(spark, landing).collect())
    return sorted(map(tuple, rows), key=str), ledger


def test_new_files_are_taken_in_once(stream):
    source, _, run = stream
    write(source / "1", "plans.csv", LINES[:5], days_ago=3)
    rows, ledger = run()
    assert rows == parsed(LINES[:5])
    assert run() == (rows, ledger)
    write(source / "2", "plans.csv", LINES[2:9], days_ago=2)
    write(source / "3", "plans.csv", LINES[:5], days_ago=1)
    rows, ledger = run()
    assert rows == parsed(LINES[:5])
    assert sorted((e[-1], e[8]) for e in ledger) == [(0, "landed"), (1, "landed"), (2, "known")]


def test_a_killed_batch_comes_again(spark, stream, monkeypatch):
    """Killed before the ledger is written, and after it but before the stream has committed."""
    source, landing, run = stream
    write(source / "1", "plans.csv", LINES[:5], days_ago=3)
    write(source / "1", "plans-2.csv", LINES[5:9], days_ago=3)
    before = intake._counted
    monkeypatch.setattr(intake, "_counted", lambda *_: 1 / 0)
    with pytest.raises(Exception, match="ZeroDivisionError|division by zero"):
        run()
    assert intake.read_ledger(spark, landing).isEmpty()
    monkeypatch.setattr(intake, "_counted", before)

    whole = intake.take_in_all
    monkeypatch.setattr(intake, "take_in_all", lambda *a, **more: (whole(*a, **more), 1 / 0))
    with pytest.raises(Exception, match="ZeroDivisionError|division by zero"):
        run()
    monkeypatch.setattr(intake, "take_in_all", whole)
    written = state(spark, landing)
    assert written[0] == parsed(LINES[:9])
    assert run() == written
    assert spark.read.parquet(f"{landing}/plans").where("kind = 'record'").count() == 9


def test_a_delivery_over_several_batches(stream):
    source, _, run = stream
    for i in range(7):
        write(source / "1", f"plans-{i}.csv", LINES[2 * i : 2 * i + 2], days_ago=500 + i)
    rows, ledger = run(files_per_batch=2)
    assert rows == parsed(LINES[:14])
    assert len({e[-1] for e in ledger}) >= 4
    write(source / "1", "plans-9.csv", LINES[14:], days_ago=900)  # late, and older than all others
    rows, _ = run(files_per_batch=2)
    assert rows == parsed(LINES)


def test_a_delivery_is_current_with_its_last_file(spark, stream):
    source, landing, run = stream
    both = {**TABLES, "others": RAW_PLANS}
    for name in ("plans", "others"):
        write(source / "1", f"{name}.csv", LINES[:3], days_ago=2)
    rows, _ = run(both)
    write(source / "2", "plans.csv", LINES[:8], days_ago=1)
    assert run(both)[0] == rows == parsed(LINES[:3])
    write(source / "2", "others.csv", LINES[:1], days_ago=1)
    assert run(both)[0] == parsed(LINES[:8])
    assert intake.current(spark, landing, "others", RAW_PLANS).count() == 1


def test_archive(stream, tmp_path):
    """Files move away after a later batch; what they held stays current."""
    source, _, run = stream
    archive = tmp_path / "archive"
    write(source / "1", "plans.csv", LINES[:5], days_ago=3)
    run(archive_dir=str(archive))
    write(source / "2", "plans.csv", LINES[:7], days_ago=2)
    run(archive_dir=str(archive))
    write(source / "3", "plans.csv", ["1,2"], "other,columns", days_ago=1)
    rows, ledger = run(archive_dir=str(archive))
    assert rows == parsed(LINES[:7])
    assert [e[8] for e in sorted(ledger, key=lambda e: e[-1])] == ["landed", "landed", "unreadable"]
    assert "\n".join([HEADER, *LINES[:5]]) + "\n" in [p.read_text() for p in archive.rglob("plans.csv")]
    assert golden.PLANS.splitlines()[0] == HEADER
