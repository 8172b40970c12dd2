"""Feed validation and table reconciliation operators on Spark DataFrames.

Layout:
    sources/    readers: CSV feed, run pins, Parquet/JDBC tables, fixtures
    functions/  Column expressions (canonical codes, guarded casts, ...)
    operators/  DataFrame -> DataFrame operators (validate, classify, renames,
                seasons, change sets, apply, publish, skew handling)
    plans/      the reconciliation run: staging, snapshots, audit
    streaming/  the same run driven by a file stream (one run per new feed)
    session.py  session settings (adaptive execution, measured-size
                broadcasts, forced skew splits) and shuffle sizing
    oracle.py   hand-written DuckDB SQL for every registered query
"""

from feedsync.constants import RunContext

__all__ = ["RunContext"]
