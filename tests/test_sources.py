
import pytest
from pyspark.sql import functions as F

from feedsync.schemas import FEED_COLUMNS, FEED_SCHEMA
from feedsync.sources import (
    JdbcSource,
    ParquetSource,
    read_feed,
    read_run_pins,
    read_table,
    split_corrupt,
    stage_parsed,
    write_feed,
)


def test_feed_csv_round_trip_keeps_blanks_and_nulls(spark, tmp_path, fixtures_small):
    listing = fixtures_small["listing"]
    path = str(tmp_path / "feed")
    write_feed(listing, path)
    back, bad = split_corrupt(stage_parsed(spark, read_feed(spark, path), str(tmp_path / "parsed")))
    assert bad.count() == 0
    assert back.columns == FEED_COLUMNS
    assert back.exceptAll(listing).count() == 0 and listing.exceptAll(back).count() == 0
    # padded lower-case codes (remainder 17) survive the round trip
    assert back.filter(F.col("raw_code").startswith(" ")).count() > 0
    assert back.filter(F.col("chain_name").isNull()).count() > 0


def test_feed_header_is_checked(spark, tmp_path):
    p = tmp_path / "swapped.csv"
    p.write_text("role,raw_code,ext_id,chain_name,hotel_name\nH,P000001,1,a,b\n")
    with pytest.raises(Exception):
        read_feed(spark, str(p)).collect()
    # without the check, binding is positional: swapped columns go in silently
    df = read_feed(spark, str(p), check_header=False, keep_corrupt=False)
    assert df.first().raw_code == "H"


def test_feed_corrupt_rows_are_kept(spark, tmp_path):
    p = tmp_path / "ragged.csv"
    p.write_text("raw_code,role,ext_id,chain_name,hotel_name\nP000001,H,1,a,b\nP000002,H,1,a,b,EXTRA\n")
    ok, bad = split_corrupt(stage_parsed(spark, read_feed(spark, str(p)), str(tmp_path / "parsed")))
    assert ok.count() + bad.count() == 2
    assert bad.count() == 1
    assert bad.first()["_corrupt_record"] == "P000002,H,1,a,b,EXTRA"


def test_run_pins(spark, tmp_path):
    p = tmp_path / "pins.csv"
    p.write_text("prop_code,run_id\nP000001,2\nP000002,x\n")
    rows = read_run_pins(spark, str(p)).collect()
    assert [(r.prop_code, r.run_id) for r in rows] == [("P000001", 2), ("P000002", None)]


def test_parquet_source_plain_and_snapshot(spark, tmp_path, fixtures_small):
    root = str(tmp_path)
    fixtures_small["property"].write.parquet(f"{root}/property.parquet")
    df = read_table(spark, ParquetSource(root), "property")
    assert df.columns == ["prop_code"] and df.count() == 136
    for run in (1, 2):
        fixtures_small["property"].limit(10 * run).withColumn("run", F.lit(run)).write.mode("append").partitionBy(
            "run"
        ).parquet(f"{root}/property")
    snap = read_table(spark, ParquetSource(root, run_id=2), "property")
    assert snap.count() == 20
    assert all("/run=2/" in f for f in snap.inputFiles())


def test_read_table_carries_all_columns(spark, tmp_path):
    row = [("P1", 5, "N", "Y", 0.5)]
    schema = "RC_PROP_CODE string, RC_CMPTN_ID int, own_ind string, active_ind string, weight double"
    spark.createDataFrame(row, schema).write.parquet(f"{tmp_path}/compset.parquet")
    names = {"rc_prop_code": "prop_code", "rc_cmptn_id": "competitor_id"}
    df = read_table(spark, ParquetSource(str(tmp_path)), "compset", rename=names)
    assert df.columns == ["prop_code", "competitor_id", "own_ind", "active_ind", "weight"]
    with pytest.raises(ValueError, match="prop_code"):
        read_table(spark, ParquetSource(str(tmp_path)), "compset")


def test_read_table_prunes_and_renames(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([("P1", 5, "x")], "RC_PROP_CODE string, RC_CMPTN_ID int, junk string").write.parquet(
        f"{root}/compset.parquet"
    )
    df = read_table(
        spark,
        ParquetSource(root),
        "compset",
        columns=["prop_code", "competitor_id"],
        rename={"rc_prop_code": "prop_code", "rc_cmptn_id": "competitor_id"},
    )
    assert df.columns == ["prop_code", "competitor_id"]
    assert "junk" not in df._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]


def test_jdbc_options_partitioned():
    src = JdbcSource(
        "jdbc:example://db/x",
        {"user": "u"},
        schema="s",
        partitioning={"comp_config": ("competitor_id", 0, 1_000_000, 64)},
    )
    o = src.read_options("comp_config")
    assert o["dbtable"] == "s.comp_config"
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == (
        "competitor_id",
        "0",
        "1000000",
        "64",
    )
    assert "partitionColumn" not in src.read_options("property")


def test_fixture_schema(fixtures_small):
    assert fixtures_small["listing"].schema == FEED_SCHEMA or [f.name for f in fixtures_small["listing"].schema] == FEED_COLUMNS


def test_jdbc_rename_applies_by_table():
    src = JdbcSource("jdbc:example://db/x", rename={"compset": {"RC_PROP_CODE": "prop_code"}})
    assert src.rename["compset"]["RC_PROP_CODE"] == "prop_code"


def test_run_job_from_csv_feed_and_parquet_tables(spark, tmp_path, fixtures_small):
    from feedsync.constants import RunContext
    from feedsync.plans.job import run_job

    tables = str(tmp_path / "tables")
    for name in ("property", "compset", "competitor", "season_map", "comp_config"):
        fixtures_small[name].write.parquet(f"{tables}/{name}.parquet")
    feed = str(tmp_path / "feed")
    write_feed(fixtures_small["listing"], feed)
    # one broken line next to the good ones
    (tmp_path / "feed" / "zz-broken.csv").write_text(
        "raw_code,role,ext_id,chain_name,hotel_name\nP000001,H,1,a,b,EXTRA\n"
    )
    pins = str(tmp_path / "pins")
    fixtures_small["run_pin"].write.option("header", "true").csv(pins)
    root = str(tmp_path / "root")
    res = run_job(spark, feed, pins, ParquetSource(tables), RunContext(run_id=1), root=root)
    c = res.counts()
    assert c["config_inserts"] == 536 and c["config_deletes"] == 417 and c["compset_diff"] == 391
    corrupt = spark.read.option("header", "true").csv(f"{root}/reports/run=1/corrupt-rows")
    assert corrupt.count() == 1
    # the next run continues from run 1's table states
    res2 = run_job(spark, feed, pins, ParquetSource(tables), RunContext(run_id=2), root=root)
    assert res2.counts()["new_hosts"] == 0
    # re-running run 2 continues from run 1 again, so it repeats run 2 exactly
    again = run_job(spark, feed, pins, ParquetSource(tables), RunContext(run_id=2), root=root)
    assert again.counts() == res2.counts()


def test_jdbc_source_from_options(tmp_path, monkeypatch):
    from feedsync.plans.job import jdbc_source

    spec = tmp_path / "tables.json"
    spec.write_text('{"compset": {"rename": {"RC_PROP_CODE": "prop_code"}, "partition": ["RC_CMPTN_ID", 0, 99, 4]}}')
    monkeypatch.setenv("DB_PASSWORD", "p")
    src = jdbc_source("jdbc:example://db/x", "s", "u", "DB_PASSWORD", "org.example.Driver", str(spec))
    o = src.read_options("compset")
    assert (o["user"], o["password"], o["driver"], o["numPartitions"]) == ("u", "p", "org.example.Driver", "4")
    assert src.rename == {"compset": {"RC_PROP_CODE": "prop_code"}}


def test_local_root_is_refused_on_a_cluster(spark):
    from feedsync.session import shared_root

    class Session:
        class sparkContext:
            master = "yarn"

            @staticmethod
            def getConf():
                return {"spark.checkpoint.dir": "file:///mnt/shared"}

    assert shared_root(spark, "/tmp/x") == "/tmp/x"
    assert shared_root(Session, "s3a://b/x") == "s3a://b/x"
    assert shared_root(Session, "/mnt/shared/x") == "/mnt/shared/x"
    with pytest.raises(ValueError, match="one machine"):
        shared_root(Session, "/tmp/x")


def test_jdbc_write_options():
    src = JdbcSource("jdbc:example://db/x", {"user": "u"}, schema="s")
    o = src.write_options("comp_config", batchsize=500, num_partitions=8)
    assert (o["dbtable"], o["batchsize"], o["numPartitions"], o["user"]) == ("s.comp_config", "500", "8", "u")


def test_shuffle_partitions_sizing(spark, tmp_path):
    from feedsync.session import input_bytes, shuffle_partitions_for

    assert shuffle_partitions_for(0, cores=8) == 16
    assert shuffle_partitions_for(10 << 30, cores=8) == 20  # 10 GiB / 512 MiB
    assert shuffle_partitions_for(100 << 40, cores=8000) == 204_800  # 100 TiB, no limit
    assert shuffle_partitions_for(1 << 40, cores=8000) == 16_000  # two waves of cores
    (tmp_path / "a").write_bytes(b"x" * 1000)
    assert input_bytes(spark, str(tmp_path)) == 1000


def test_cli_main(spark, tmp_path, fixtures_small, capsys):
    from feedsync.plans.job import main

    tables = str(tmp_path / "tables")
    for name in ("property", "compset", "competitor", "season_map", "comp_config"):
        fixtures_small[name].write.parquet(f"{tables}/{name}.parquet")
    feed = str(tmp_path / "feed")
    write_feed(fixtures_small["listing"], feed)
    pins = str(tmp_path / "pins")
    fixtures_small["run_pin"].write.option("header", "true").csv(pins)
    root = str(tmp_path / "root")
    main(["--feed", feed, "--season-pins", pins, "--tables", tables, "--root", root, "--run-id", "3",
          "--data-date", "2024-01-01"])
    out = capsys.readouterr().out
    assert any(line.split()[:2] == ["config_inserts", "536"] for line in out.splitlines())
