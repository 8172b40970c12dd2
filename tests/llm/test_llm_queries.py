"""Operator 1, the registered queries against their SQL, and the pipeline."""

import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from feedsync.llm import mtree, queries
from feedsync.llm.common import ship_package, staged

SF = "/root/testdata/sf0.001"


def brute_top_k(rows, k, every):
    q = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and abs(x) < 65_536 for x in v):
            x = [int(np.floor(64 * np.float64(np.float32(c)))) for c in v]
            q[i] = min(q.get(i, x), x)
    out = []
    for i in sorted(q):
        if i % every == 0:
            score = lambda a, b: sum(x * y for x, y in zip(q[a], q[b], strict=False))
            best = sorted((-score(i, j), j) for j in q if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return out


@pytest.mark.parametrize("shard_rows", [60, 100_000])
def test_top_k_equals_brute_force(spark, monkeypatch, shard_rows):
    ship_package(spark)
    monkeypatch.setattr(mtree, "PAGE", 16)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 12)) * 0.4
    rows = [(int(i), (centres[i % 6] + 0.1 * rng.normal(size=12)).tolist()) for i in range(500)]
    rows += [(1000 + i, centres[0].tolist()) for i in range(250)]  # one vector repeated
    rows += [(2000, None), (2020, [1.0] * 11 + [None]), (2040, [float("nan")] * 12), (2060, [float("inf")] + [0.0] * 11)]
    rows += [(2080, [1e30] * 12), (2100, [1e9] + [0.0] * 11), (2120, [-65_536.0] * 12)]  # beyond exact scores
    rows += [(None, centres[1].tolist()), (3000, [0.5, 0.5]), (3020, []), (5, centres[2].tolist()), (40, [9.0] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    table = staged(mtree.quantised(df, "embedding"), "t")
    index = mtree.build_index(table, shard_rows)
    got = mtree.search(index, table.filter("vec_id % 20 = 0"), 20).collect()
    assert sorted(map(tuple, got)) == brute_top_k(rows, 20, 20)
    if shard_rows == 60:
        assert len(index.pivots) > 5 and int(index.subs.max()) > 1


def test_top_k_small_tables(spark):
    ship_package(spark)
    schema = "vec_id long, embedding array<float>, score string, rank int"
    df = spark.createDataFrame([(0, [1.0, 2.0], "a", 1), (20, [0.5, 0.0], "b", 2), (3, [-1.0, 0.0], "c", 3)], schema)
    got = sorted(map(tuple, mtree.top_k(df).collect()))
    assert got == [(0, 1, 20, 2048), (0, 2, 3, -4096), (20, 1, 0, 2048), (20, 2, 3, -2048)]
    assert mtree.top_k(df.limit(0)).count() == 0
    assert mtree.top_k(df.limit(1)).count() == 0


def test_bounds_spare_distances():
    """Stored distances leave far pages and entries uncomputed, with the same result."""
    rng = np.random.default_rng(0)
    centres = rng.integers(-30, 30, (20, 4))
    x = (np.repeat(centres, 400, axis=0) + rng.integers(-2, 3, (8000, 4))).astype(float)
    top = float((x * x).sum(1).max())
    page, mtree.PAGE = mtree.PAGE, 64
    try:
        tree = mtree.MTree(np.arange(8000), x, top)
    finally:
        mtree.PAGE = page
    computed = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            computed.append(len(self))
            return np.asarray(self) @ np.asarray(other)

    q = x[123]
    want = sorted(zip((-(x @ q)).tolist(), range(8000), strict=True))[:5]
    tree.x = tree.x.view(Counted)
    ids, scores = tree.search(q, None, 5, np.inf)
    assert list(zip((-scores).tolist(), ids.tolist(), strict=True)) == want
    assert sum(computed) < 8000


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = duck.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLES])
def test_query_covers_its_table(spark, duck, name):
    ids = {r["doc_id"] for r in queries.QUERIES[name](spark, SF).select("doc_id").distinct().collect()}
    assert ids == {r[0] for r in duck.execute("SELECT doc_id FROM documents").fetchall()}


def test_registered():
    found = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in found) for i in range(1, 11)) and "pipeline" in found
    assert set(queries.ORACLES) <= set(entry.oracle_sql())


def test_pipeline_stages(spark, duck):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = staged(stage(spark, before, SF), name)
        assert after.columns == columns
        ids = {r[0] for r in before.select("doc_id").collect()}
        left = {r[0] for r in after.select("doc_id").collect()}
        assert left <= ids and len(left) == after.count()
        if name == "substring_dedup":
            assert left == ids
            pairs = {r["doc_id"]: r for r in before.collect()}
            for r in after.collect():
                old = pairs[r["doc_id"]]
                assert len(r["text"].split()) <= len(old["text"].split())
                assert r["n_chars"] == (old["n_chars"] if r["text"] == old["text"] else len(r["text"]))
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == {r[0] for r in before.select("doc_id").collect()}


def test_pipeline_on_odd_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "a b", "en", "s", 3), (4, "a  b", "en", "s", 4)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 3]
    empty = str(tmp_path / "none")
    os.makedirs(empty)
    spark.createDataFrame([], schema).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
