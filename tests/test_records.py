"""Strict feed reader: quoted line breaks across blocks, and a reason for each rejected field."""

import csv
import random

import pytest
from conftest import rows_of

from feedsync.schemas import FEED_COLUMNS
from feedsync.sources import Dialect, Field, accepted, check_fields, read_records, rejects

HEADER = ",".join(FEED_COLUMNS) + "\n"
DOUBLED = Dialect(escape='"')


@pytest.fixture
def small_blocks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _rejects(spark, path, **kw):
    return {(r.record, r.field, r.reason, r.value) for r in rejects(check_fields(read_records(spark, path, **kw))).collect()}


def test_reasons(spark, tmp_path):
    p = tmp_path / "feed.csv"
    p.write_text(
        HEADER + 'P1,H,1,a,b\nP2,X,abc,a,\n\nP3,H,99999999999,,5" pipe\nP4,H,1,a,b,EXTRA\nP5,H\nP6,H,1,a,b,\n,H,,a,b\n'
    )
    checked = check_fields(read_records(spark, str(p), header=FEED_COLUMNS))
    got = {(r.record, r.field, r.reason, r.value) for r in rejects(checked).collect()}
    assert got == {
        ("P2,X,abc,a,", "role", "not allowed", "X"),
        ("P2,X,abc,a,", "ext_id", "not a whole number", "abc"),
        ("P2,X,abc,a,", "hotel_name", "missing", None),
        ('P3,H,99999999999,,5" pipe', "ext_id", "out of range", "99999999999"),
        ("P4,H,1,a,b,EXTRA", None, "6 fields, not 5", None),
        ("P5,H", None, "2 fields, not 5", None),
        ("P6,H,1,a,b,", None, "6 fields, not 5", None),
        (",H,,a,b", "raw_code", "missing", None),
    }
    assert [tuple(r) for r in accepted(checked).collect()] == [("P1", "H", "1", "a", "b")]
    assert accepted(checked, typed=True).schema["ext_id"].dataType.simpleString() == "int"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_quoted_line_breaks_over_many_blocks(spark, tmp_path, small_blocks, seed):
    rnd = random.Random(seed)
    texts = ["a", "b c", "x\ny", 'q "u" q', ",", "\n", "\n\nlong " + "w" * 60 + "\n", "é\nü", "''"]
    want = []
    for f in range(2):
        rows = [
            [f"P{f}{i}", "H", str(i), rnd.choice(texts), "h" + rnd.choice(texts)] for i in range(rnd.randint(150, 200))
        ]
        want += [tuple(r) for r in rows]
        with open(tmp_path / f"f{f}.csv", "w", newline="") as out:
            out.write(HEADER)
            csv.writer(out, lineterminator="\n", quoting=rnd.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL])).writerows(rows)
    (tmp_path / "f2.csv").write_text(HEADER + "P9,H,1,a,b\n")
    want.append(("P9", "H", "1", "a", "b"))
    records = read_records(spark, str(tmp_path), header=FEED_COLUMNS, dialect=DOUBLED)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
    checked = check_fields(records, dialect=DOUBLED)
    assert rejects(checked).count() == 0
    assert sorted(tuple(r) for r in accepted(checked).collect()) == sorted(want)


def test_backslash_quotes_equal_the_csv_reader(spark, tmp_path, small_blocks):
    rows = [(f"P{i}", "C", str(i), ['a "b", c', "x\ny", "\\", "z"][i % 4], "h") for i in range(300)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in FEED_COLUMNS))
    df.write.csv(str(tmp_path / "feed"), header=True)
    back = spark.read.csv(str(tmp_path / "feed"), header=True, multiLine=True)
    checked = check_fields(read_records(spark, str(tmp_path / "feed"), header=FEED_COLUMNS))
    assert rejects(checked).count() == 0
    assert rows_of(accepted(checked)) == rows_of(back) == rows_of(df)


def test_a_quote_that_never_closes_loses_no_line(spark, tmp_path, small_blocks):
    tail = [f"P{i},H,1,a,b" for i in range(100)]
    (tmp_path / "f.csv").write_text('P,H,1,a,b\nQ,H,1,"open,b\n' + "\n".join(tail) + "\n")
    whole = _rejects(spark, str(tmp_path))
    assert {r[0] for r in whole} == {'Q,H,1,"open,b', *tail} and {r[2] for r in whole} == {"quote not closed"}
    # a closed record that is longer than allowed, then a good one
    long = tmp_path / "long"
    long.mkdir()
    (long / "f.csv").write_text('Q,H,1,"' + "\n".join(["x"] * 40) + '",b\nP,H,1,a,b\n')
    checked = check_fields(read_records(spark, str(long), max_lines=20))
    assert rejects(checked).count() == 40 and accepted(checked).count() == 1
    checked = check_fields(read_records(spark, str(long), max_lines=40))
    assert rejects(checked).count() == 0 and accepted(checked).count() == 2


def test_header_and_empty_feeds(spark, tmp_path):
    (tmp_path / "a.csv").write_text("role,raw_code,ext_id,chain_name,hotel_name\nH,P1,1,a,b\n")
    with pytest.raises(ValueError, match="lack the header"):
        read_records(spark, str(tmp_path), header=FEED_COLUMNS)
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "a.csv").write_text(HEADER)
    checked = check_fields(read_records(spark, str(empty), header=FEED_COLUMNS))
    assert checked.count() == 0 and rejects(checked).count() == 0


def test_other_types_and_patterns(spark, tmp_path):
    (tmp_path / "f.csv").write_text("P000001;2024-01-31;1.5\nQ;2024-02-31;x\n;;\n")
    rules = (Field("code", pattern="P[0-9]{6}", required=True), Field("day", "date"), Field("w", "decimal(5,2)"))
    semi = Dialect(sep=";")
    checked = check_fields(read_records(spark, str(tmp_path), dialect=semi), rules, semi)
    got = {(r.field, r.reason, r.value) for r in rejects(checked).collect()}
    assert got == {
        ("code", "malformed", "Q"), ("day", "not a date", "2024-02-31"), ("w", "not a decimal(5,2)", "x"),
        ("code", "missing", None),
    }
    row = accepted(checked, rules, typed=True).first()
    assert (row.code, str(row.day), str(row.w)) == ("P000001", "2024-01-31", "1.50")


def test_strict_run_reports_rejected_fields(spark, tmp_path, fixtures_small):
    from feedsync.constants import RunContext
    from feedsync.operators import verify_export
    from feedsync.plans.job import run_job
    from feedsync.plans.round_trips import EXPORT_ORDER
    from feedsync.sources import FEED_FIELDS, ParquetSource, write_feed

    for name in ("property", "compset", "competitor", "comp_config"):
        fixtures_small[name].write.parquet(f"{tmp_path}/tables/{name}.parquet")
    fixtures_small["season_map"].write.partitionBy("run_id").parquet(f"{tmp_path}/tables/season_map.parquet")
    write_feed(fixtures_small["listing"], f"{tmp_path}/feed")
    fixtures_small["run_pin"].write.option("header", "true").csv(f"{tmp_path}/pins")
    source = ParquetSource(f"{tmp_path}/tables", folders={"season_map": "run_id"})
    args = (spark, f"{tmp_path}/feed", f"{tmp_path}/pins", source, RunContext(run_id=1))
    loose = run_job(*args, root=f"{tmp_path}/loose").counts()
    assert loose["config_inserts"] == 536 and loose["config_deletes"] == 417
    res = run_job(*args, root=f"{tmp_path}/strict", strict=FEED_FIELDS, ordered_export=True)
    strict, state = res.counts(), spark.read.parquet(res.paths["config_after"])
    listed = verify_export(spark, res.layout.export("comp_config"), state.schema, EXPORT_ORDER)
    assert sum(r.n_rows for r in listed.collect()) == strict["config_after"] == state.count()
    faults = spark.read.option("header", "true").csv(f"{tmp_path}/strict/reports/run=1/rejected-fields")
    assert faults.count() == strict["rejected_fields"] > 0
    assert {r.reason for r in faults.select("reason").distinct().collect()} == {"missing", "not a whole number"}
