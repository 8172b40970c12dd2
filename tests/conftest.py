import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from feedsync.session import build_session

    s = build_session(
        "local[4]",
        app="feedsync-tests",
        shuffle_partitions=8,
        extra={
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    # Tests set their own shared folder only because none is configured.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fixtures_small(spark):
    from feedsync.sources.fixtures import load_fixtures

    return load_fixtures(spark, SF_SMALL)


@pytest.fixture(scope="session")
def views_small(fixtures_small):
    from feedsync.plans.views import reconcile_views

    return reconcile_views(fixtures_small)


@pytest.fixture
def duck_small():
    """A connection of its own for each test, so that one fatal error stays one failure."""
    import duckdb

    con = duckdb.connect(config={"threads": 2, "memory_limit": "2GB"})
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    yield con
    con.close()


def rows_of(df, cols=None):
    """Order-insensitive multiset of rows as tuples of strings."""
    pdf = df.toPandas() if hasattr(df, "toPandas") else df
    cols = sorted(cols or pdf.columns)
    pdf = pdf[cols]

    def norm(v):
        if v is None:
            return None
        try:
            import pandas as pd

            if pd.isna(v):
                return None
        except (TypeError, ValueError):
            pass
        if isinstance(v, float) and v.is_integer():
            return str(int(v))
        return str(v)

    return sorted((tuple(norm(v) for v in r) for r in pdf.itertuples(index=False)), key=repr)
