"""Domain tables derived from the driver's TPC-H style tables (FIXTURES.md).

A customer stands for a host property, a supplier for a competitor, and a
(customer, supplier) pair that traded for a compset membership.  Faults are
planted by remainder of the key, so every operator has rows to return.  The
remainders only *label* rows; no customer or pair is dropped to make a check
cheaper, so every table grows with the inputs.

Fixed values (FIXTURES.md §2): customer remainders 11 no property, 13 not in
compset/competitor, 17 lower-case padded code, 19 malformed code, 23 no host
row, 29 second host row, 31 non-numeric id, 37 NULL chain, 41 other stored own
id, 43 other stored host name, 47 no seasons, 53 also listed as its own
competitor, 61 (remainder 7) settled: the config holds what the feed lists and one more
competitor is listed without a number; (custkey + suppkey) remainders of a listing: 89 NULL name, 97
non-numeric id; supplier remainders 5 other stored
name, 7 not stored; pair remainder (7*custkey + suppkey) mod 10: 0-1 feed only,
8-9 table only; (custkey + suppkey) mod 59 = 0: a second, earlier range in compset, which
overlaps, touches or leaves a gap by custkey mod 3; comp_config leaves out pair remainder 0 and
(custkey + suppkey) mod 9 = 0, its weekend flag is turned for (custkey + 2 * suppkey) mod
61 = 0 and NULL for mod 71 = 0, its own flag is 'Y' for (2 * custkey + suppkey) mod 67 = 0; three runs of two seasons each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TPCH_TABLES = ("customer", "supplier", "nation", "orders", "lineitem")


def _code(k: Column) -> Column:
    """``P`` and the key, padded to six digits and never cut."""
    digits = k.cast("string")
    return F.concat(F.lit("P"), F.lpad(digits, F.greatest(F.lit(6), F.length(digits)), F.lit("0")))


def _supplier_id(k: Column) -> Column:
    """Competitor ids of suppliers, own ids and other own ids never overlap, at any size."""
    return k * 3


def _own_id(k: Column) -> Column:
    return k * 3 + 1


def _other_id(k: Column) -> Column:
    return k * 3 + 2


# Fixed audit values of rows that were stored before the run.
OLD_USER, OLD_TS = "seed", "2020-01-01 00:00:00"


def _audited(df: DataFrame) -> DataFrame:
    return df.withColumns({"last_upd_by": F.lit(OLD_USER), "last_upd_ts": F.lit(OLD_TS).cast("timestamp")})


def _pairs(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    o = orders.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("custkey"))
    li = lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_suppkey").alias("suppkey"))
    return o.join(li, "k").select("custkey", "suppkey").distinct()


def _hosts(customer: DataFrame) -> DataFrame:
    c = F.col("c_custkey")
    code = _code(c)
    return customer.select(
        c.alias("custkey"),
        code.alias("prop_code"),
        F.when(c % 17 == 0, F.concat(F.lit(" "), F.lower(code), F.lit(" ")))
        .when(c % 19 == 0, F.concat(F.lit("X-"), c.cast("string")))
        .otherwise(code)
        .alias("feed_code"),
        F.when(c % 31 == 0, F.lit("n/a")).otherwise(_own_id(c).cast("string")).alias("feed_ext_id"),
        F.when(c % 37 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("chain"),
        F.col("c_name").alias("hotel"),
    )


def fixture_tables(
    tables: dict[str, DataFrame], stage: Callable[[str, DataFrame], DataFrame] = lambda name, df: df
) -> dict[str, DataFrame]:
    """Build ``listing`` (the feed) and the reference tables from TPC-H tables.  Three of them
    read the pairs that traded, which go through ``stage`` as ``pairs``; so does ``comp_config``."""
    customer, supplier, nation = tables["customer"], tables["supplier"], tables["nation"]
    pairs = stage("pairs", _pairs(tables["orders"], tables["lineitem"]))
    host = _hosts(customer)
    pk = (F.col("custkey") * 7 + F.col("suppkey")) % 10
    both = F.col("custkey") + F.col("suppkey")
    cust = F.col("c_custkey")
    settled = F.col("custkey") % 61 == 7

    host_rows = host.filter(F.col("custkey") % 23 != 0)
    dup_rows = host.filter(F.col("custkey") % 29 == 0)
    hcols = [
        F.col("feed_code").alias("raw_code"),
        F.lit("H").alias("role"),
        F.col("feed_ext_id").alias("ext_id"),
        F.col("chain").alias("chain_name"),
        F.col("hotel").alias("hotel_name"),
    ]
    supp = supplier.select(
        F.col("s_suppkey").alias("suppkey"), "s_name", F.col("s_nationkey").alias("n_nationkey")
    ).join(nation.select("n_nationkey", "n_name"), "n_nationkey")
    comp_rows = (
        pairs.filter(pk < 8)
        .join(host.select("custkey", "feed_code"), "custkey")
        .join(supp, "suppkey")
        .select(
            F.col("feed_code").alias("raw_code"),
            F.lit("C").alias("role"),
            F.when(both % 97 == 0, F.concat(F.lit("id "), F.col("suppkey").cast("string")))
            .otherwise(_supplier_id(F.col("suppkey")).cast("string"))
            .alias("ext_id"),
            F.col("n_name").alias("chain_name"),
            F.when(both % 89 != 0, F.col("s_name")).alias("hotel_name"),
        )
    )
    # hosts that the feed lists among their own competitors too
    own_rows = host.filter(F.col("custkey") % 53 == 0).select(
        *[F.lit("C").alias("role") if i == 1 else c for i, c in enumerate(hcols)]
    )
    # settled hosts: the config holds just what the feed lists, but for one competitor
    # whose id is not a number
    unnumbered = host.filter(settled).select(
        F.col("feed_code").alias("raw_code"), F.lit("C").alias("role"), F.lit("n/a").alias("ext_id"),
        F.lit("NEW").alias("chain_name"), F.col("hotel").alias("hotel_name"),
    )
    listing = (
        host_rows.select(hcols)
        .unionByName(dup_rows.select(hcols))
        .unionByName(own_rows)
        .unionByName(unnumbered)
        .unionByName(comp_rows)
    )

    prop = customer.filter(cust % 11 != 0).select(_code(cust).alias("prop_code"))

    kept_pairs = pairs.filter(F.col("custkey") % 13 != 0).join(host.select("custkey", "prop_code"), "custkey")
    ck, day = F.col("custkey"), F.to_date(F.lit("2020-01-01"))
    # an earlier range of some pairs: it overlaps the later one, touches it or leaves a gap
    first = F.date_add(day, (ck % 365).cast("int"))
    earlier = kept_pairs.filter((pk >= 2) & (both % 59 == 0)).select(
        "prop_code",
        _supplier_id(F.col("suppkey")).cast("int").alias("competitor_id"),
        F.lit("N").alias("own_ind"),
        F.lit("N").alias("active_ind"),
        F.date_sub(first, 100).alias("eff_start_date"),
        F.date_add(first, F.when(ck % 3 == 0, 10).when(ck % 3 == 1, -1).otherwise(-30)).alias("eff_end_date"),
    )
    compset = _audited(
        kept_pairs.filter(pk >= 2)
        .select(
            "prop_code",
            _supplier_id(F.col("suppkey")).cast("int").alias("competitor_id"),
            F.lit("N").alias("own_ind"),
            F.when((ck + F.col("suppkey")) % 4 == 0, F.lit("N")).otherwise(F.lit("Y")).alias("active_ind"),
            F.date_add(day, (ck % 365).cast("int")).alias("eff_start_date"),
            F.when(F.col("suppkey") % 6 == 0, F.to_date(F.lit("2023-06-30"))).alias("eff_end_date"),
        )
        .unionByName(
            host.filter(ck % 13 != 0).select(
                "prop_code",
                F.when(ck % 41 == 0, _other_id(ck)).otherwise(_own_id(ck)).cast("int").alias("competitor_id"),
                F.lit("Y").alias("own_ind"),
                F.lit("Y").alias("active_ind"),
                day.alias("eff_start_date"),
                F.lit(None).cast("date").alias("eff_end_date"),
            )
        )
        .unionByName(earlier)
    )

    old = lambda cond: F.when(cond, F.lit("OLD ")).otherwise(F.lit(""))
    s = F.col("suppkey")
    competitor = (
        supp.filter(s % 7 != 0)
        .select(
            _supplier_id(s).cast("int").alias("competitor_id"),
            F.concat(old(s % 5 == 0), F.col("n_name"), F.lit(" "), F.col("s_name")).alias("competitor_name"),
        )
        .unionByName(
            customer.filter(cust % 13 != 0).select(
                _own_id(cust).cast("int").alias("competitor_id"),
                F.concat(old(cust % 43 == 0), F.col("c_mktsegment"), F.lit(" "), F.col("c_name")).alias(
                    "competitor_name"
                ),
            )
        )
    )

    competitor = _audited(competitor)

    season_map = (
        customer.filter(cust % 47 != 0)
        .select(_code(cust).alias("prop_code"), F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("r"))
        .select("prop_code", "r", F.explode(F.array(F.lit(1), F.lit(2))).alias("s"))
        .select(
            "prop_code",
            F.col("r").cast("bigint").alias("run_id"),
            (F.col("r") * 10 + F.col("s")).cast("int").alias("season_id"),
            F.when(F.col("s") == 1, F.lit("N")).otherwise(F.lit("Y")).alias("we_ind"),
        )
    )

    run_pin = customer.select(_code(cust).alias("prop_code"), (1 + cust % 3).cast("bigint").alias("run_id"))

    stored = F.when(settled, (pk < 8) & (both % 97 != 0)).otherwise((pk >= 1) & (both % 9 != 0))
    own = host.filter(settled & (ck % 13 != 0)).select(
        "prop_code", "custkey", F.lit(None).cast("bigint").alias("suppkey"), _own_id(ck).alias("id")
    )
    comp_config = (
        kept_pairs.filter(stored)
        .select("prop_code", "custkey", "suppkey", _supplier_id(s).alias("id"))
        .unionByName(own)
        .select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("s"))
    )
    flag = lambda cond: F.when(cond, F.lit("Y")).otherwise(F.lit("N"))
    amount = lambda n, d: (n / F.lit(d)).cast("decimal(38,18)")
    weekend, odd = flag(F.col("s") != 1), ~settled
    comp_config = comp_config.select(
        "prop_code",
        F.col("id").cast("int").alias("competitor_id"),
        ((1 + ck % 3) * 10 + F.col("s")).cast("int").alias("season_id"),
        F.when(odd & ((ck + 2 * s) % 71 == 0), F.lit(None).cast("string"))
        .when(odd & ((ck + 2 * s) % 61 == 0), flag(F.col("s") == 1))
        .otherwise(weekend)
        .alias("we_ind"),
        flag(s % 3 == 0).alias("cmptn_ind"),
        amount(1 + ck % 100, 8).alias("sys_weight"),
        amount(1 + s % 100, 4).alias("usr_weight"),
        amount(1 + s % 50, 64).alias("closed_fill_in_rt"),
        F.when(s % 4 == 0, amount(1 + ck % 10, 2)).alias("closed_fill_in_usr"),
        flag(s.isNull() | (odd & ((2 * ck + s) % 67 == 0))).alias("own_ind"),
        (ck % 7).cast("int").alias("prd_profile_id"),
    )
    comp_config = stage("comp_config", _audited(comp_config))

    return {
        "listing": listing,
        "property": prop,
        "compset": compset,
        "competitor": competitor,
        "season_map": season_map,
        "run_pin": run_pin,
        "comp_config": comp_config,
    }


def feed_lines(tables: dict[str, DataFrame]) -> DataFrame:
    """The feed as text lines (``value``), and one more record for each customer, by its
    remainder mod 8: 0 a field too many, 1 two fields only, 2 a line break in quotes, 3 an unknown
    role and an id that is no number, 4 an id out of range, 5 no code and no name, 6 a comma and
    escaped quotes in quotes, 7 all fields quoted, two line breaks."""
    listing = fixture_tables(tables)["listing"]
    k = F.col("c_custkey")
    own, seg, name = _own_id(k).cast("string"), F.col("c_mktsegment"), F.col("c_name")
    line = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    shapes = [
        line(_code(k), ",H,", own, ",", seg, ",", name, ",EXTRA"),
        line(_code(k), ",H"),
        line(_code(k), ",H,", own, ',"', seg, '\nannex",', name),
        line(_code(k), ",X,no ", own, ",", seg, ",", name),
        line(_code(k), ",C,99999", F.lpad(own, 9, "0"), ",", seg, ",", name),
        line(",H,", own, ",", seg, ","),
        line(_code(k), ",C,", own, ',"', seg, ', \\"two\\"",', name),
        line('"', _code(k), '","H","', own, '","', seg, '\n\n","', name, ',x"'),
    ]
    planted = tables["customer"].select(F.element_at(F.array(*shapes), (k % 8 + 1).cast("int")).alias("value"))
    rows = listing.select(F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in listing.columns]).alias("value"))
    return rows.unionByName(planted)


def load_tpch(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in TPCH_TABLES}


def load_fixtures(spark: SparkSession, sf_dir: str, **kw) -> dict[str, DataFrame]:
    return fixture_tables(load_tpch(spark, sf_dir), **kw)
