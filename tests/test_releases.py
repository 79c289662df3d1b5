"""Publishing: all tables of a run become current at once, or none."""

import golden
import pytest
from test_golden import REPORT_ROWS, STAGED_ROWS, deliver, same

from tariffbook.plans import jobs
from tariffbook.schemas import ENRICHED_SUBSCRIPTIONS, PLAN_PRICE_HISTORY
from tariffbook.sources import releases
from tariffbook.streaming import intake


@pytest.fixture
def place(spark, tmp_path):
    source, out = tmp_path / "source", tmp_path / "out"
    deliver(source / "1")
    return source, out, lambda **more: jobs.publish(spark, str(source), str(out), golden.AS_OF, **more)


def test_publish(spark, place):
    source, out, run = place
    assert releases.published(spark, str(out)) is None
    with pytest.raises(FileNotFoundError):
        jobs.published(spark, str(out), "enriched_subscriptions", ENRICHED_SUBSCRIPTIONS)
    assert run() == STAGED_ROWS | REPORT_ROWS
    assert releases.published_rows(spark, str(out)) == STAGED_ROWS | REPORT_ROWS
    same(jobs.published(spark, str(out), "enriched_subscriptions", ENRICHED_SUBSCRIPTIONS), golden.ENRICHED_SUBSCRIPTIONS)

    deliver(source / "2", subscriptions="\n".join(golden.SUBSCRIPTIONS.splitlines()[:11]))
    run()
    now = jobs.published(spark, str(out), "enriched_subscriptions", ENRICHED_SUBSCRIPTIONS)
    assert now.count() == 9
    run(keep=1)
    assert sorted(p.name for p in (out / "runs").iterdir()) == ["run=3"]
    assert releases.published(spark, str(out))[0] == 3


@pytest.mark.parametrize("fails", [1, 4, 6])
def test_a_failed_run_leaves_the_last_one_whole(spark, place, monkeypatch, fails):
    """Whichever write of a run fails, readers see the run before, and the next run is not hindered."""
    source, out, run = place
    run()
    before = releases.published(spark, str(out))
    deliver(source / "2", subscriptions="\n".join(golden.SUBSCRIPTIONS.splitlines()[:11]))
    writes, table, report = [], jobs.write_table, jobs.export_csv

    def counted(write):
        def run_it(*args, **more):
            writes.append(args)
            if len(writes) == fails:
                raise OSError("disk gone")
            return write(*args, **more)

        return run_it

    with monkeypatch.context() as patched:
        patched.setattr(jobs, "write_table", counted(table))
        patched.setattr(jobs, "export_csv", counted(report))
        with pytest.raises(OSError, match="disk gone"):
            run()
    assert releases.published(spark, str(out)) == before
    same(jobs.published(spark, str(out), "enriched_subscriptions", ENRICHED_SUBSCRIPTIONS), golden.ENRICHED_SUBSCRIPTIONS)
    same(jobs.published(spark, str(out), "plan_price_history", PLAN_PRICE_HISTORY), golden.PLAN_PRICE_HISTORY)
    assert run()["enriched_subscriptions"] == 9
    assert releases.published(spark, str(out))[0] == 3
    assert sorted(p.name for p in (out / "runs").iterdir()) == ["run=1", "run=3"]


def test_bad_lines_are_rejects(spark, place):
    source, out, run = place
    lines = golden.PLANS.splitlines()
    deliver(source / "2", plans="\n".join([*lines[:3], "PLAN001,Basic", *lines[3:], '"PLAN002,Pro,1,1/1/2024,']))
    assert run() == STAGED_ROWS | REPORT_ROWS | {"rejects": STAGED_ROWS["rejects"] + 2}
    rejects = spark.read.parquet(f"{releases.published(spark, str(out))[1]}/staged/rejects")
    found = {(r["record_id"].rsplit("/", 2)[1:][0], r["record_id"].rsplit(":", 1)[1], r["rule"]) for r in rejects.where("record_id LIKE '%plans.csv:%'").collect()}
    assert found == {("2", "4", "too_few_fields"), ("2", "25", "open_quote")}
    total = intake.read_ledger(spark, f"{out}/landing").where("table = 'plans' AND number = 1").first()
    assert (total["rows"], total["bad"]) == (22, 2)
