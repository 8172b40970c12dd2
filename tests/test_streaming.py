"""File-driven runs: each batch of arrived feed files is one run."""

from pyspark.sql import functions as F

from feedsync.constants import RunContext
from feedsync.plans.snapshots import latest_complete_run
from feedsync.sources import ParquetSource, write_feed
from feedsync.streaming import start_feed_stream


def test_stream_runs_once_per_delivery(spark, tmp_path, fixtures_small):
    tables = str(tmp_path / "tables")
    for name in ("property", "compset", "competitor", "season_map", "comp_config"):
        fixtures_small[name].write.parquet(f"{tables}/{name}.parquet")
    pins = str(tmp_path / "pins")
    fixtures_small["run_pin"].write.option("header", "true").csv(pins)
    inbox = tmp_path / "inbox"
    write_feed(fixtures_small["listing"].coalesce(1), str(tmp_path / "day1"))
    inbox.mkdir()
    for f in (tmp_path / "day1").glob("part-*.csv"):
        (inbox / "day1.csv").write_text(f.read_text())
    root = str(tmp_path / "root")
    ctx = lambda run_id: RunContext(run_id=run_id)
    q = start_feed_stream(spark, str(inbox), pins, ParquetSource(tables), root, context=ctx)
    q.awaitTermination(300)
    assert latest_complete_run(spark, root) == 1
    audit = spark.read.parquet(f"{root}/audit").filter(F.col("run") == 1)
    got = {r.output: r.n_rows for r in audit.collect()}
    assert got["config_inserts"] == 536 and got["compset_diff"] == 391

    # a second delivery: one more run on top of run 1's state
    (inbox / "day2.csv").write_text((inbox / "day1.csv").read_text())
    q = start_feed_stream(spark, str(inbox), pins, ParquetSource(tables), root, context=ctx)
    q.awaitTermination(300)
    assert latest_complete_run(spark, root) == 2
    got2 = {r.output: r.n_rows for r in spark.read.parquet(f"{root}/audit").filter("run = 2").collect()}
    assert got2["new_hosts"] == 0


def test_two_waiting_deliveries_become_two_runs(spark, tmp_path, fixtures_small):
    tables = str(tmp_path / "tables")
    for name in ("property", "compset", "competitor", "season_map", "comp_config"):
        fixtures_small[name].write.parquet(f"{tables}/{name}.parquet")
    pins = str(tmp_path / "pins")
    fixtures_small["run_pin"].write.option("header", "true").csv(pins)
    write_feed(fixtures_small["listing"].coalesce(1), str(tmp_path / "feed"))
    text = next((tmp_path / "feed").glob("part-*.csv")).read_text()
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "a.csv").write_text(text)
    (inbox / "b.csv").write_text(text)
    root = str(tmp_path / "root")
    q = start_feed_stream(
        spark, str(inbox), pins, ParquetSource(tables), root,
        context=lambda run_id: RunContext(run_id=run_id),
    )
    q.awaitTermination(300)
    audit = spark.read.parquet(f"{root}/audit")
    runs = {r.run: r.n_rows for r in audit.filter("output = 'new_hosts'").collect()}
    assert runs == {1: 10, 2: 0}  # the second run starts from the first one's state


def test_stream_checks_the_header(spark, tmp_path, fixtures_small):
    import pytest

    (tmp_path / "inbox").mkdir()
    (tmp_path / "inbox" / "a.csv").write_text("role,raw_code,ext_id,chain_name,hotel_name\nH,P000001,1,a,b\n")
    q = start_feed_stream(
        spark, str(tmp_path / "inbox"), str(tmp_path / "pins"), ParquetSource(str(tmp_path)), str(tmp_path / "root"),
        context=lambda run_id: RunContext(run_id=run_id),
    )
    with pytest.raises(Exception, match="header"):
        q.awaitTermination(120)
