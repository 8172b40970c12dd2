"""The reconciliation as one lazy graph of named DataFrames.

``reconcile_views`` wires every operator together without triggering an
action; the registered queries pick single views from it, and the staged run
(:mod:`feedsync.plans.run`) materialises the shared ones once.  Each view is
built on first use together with what it depends on, so asking for one output
does not construct (and analyse) the other forty.

Shape of the graph: the feed is checked row by row (no shuffle), grouped once
per code (map-side combined), the per-code summary is classified against the
reference tables (joins of one-row-per-key tables), and the feed is joined
with that summary once.  Every row set after that - single-host rows, matched
rows, the three reports - is a filter of the tagged feed.
"""

from __future__ import annotations

import copy
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedsync.constants import NOT_OWN_FLAG, OWN_FLAG, PAIR_KEYS, RunContext
from feedsync.operators import (
    apply_changes,
    apply_updates,
    change_set,
    check_codes,
    deactivate_changes,
    classify_codes,
    competitor_upserts,
    compset_diff,
    config_pairs,
    config_updates,
    derive,
    expand_seasons,
    host_groups,
    new_hosts,
    pin_runs,
    rename_listings,
    rename_records,
    renamed_hosts,
    renamed_pairs,
    reports_from_tags,
    season_counts,
    season_rows,
    split_named,
    tag_rows,
    tagged_report,
    touched,
    upsert,
)
from feedsync.operators.classify import MATCH, NO_PROPERTY, NON_SINGLE, current_rows
from feedsync.operators.history import apply_history
from feedsync.operators.reports import DUPLICATE_HOST, ID_MISMATCH, MISSING_PROPERTY
from feedsync.operators.seasons import own_flag
from feedsync.schemas import FEED_COLUMNS
from feedsync.sources.clustered import scoped

ROW_COLS = FEED_COLUMNS + ["prop_code", "competitor_id", "competitor_name"]

Stage = Callable[[str, DataFrame], DataFrame]


def lazy(name: str, df: DataFrame) -> DataFrame:
    return df


@dataclass(frozen=True)
class SkewConf:
    """Skew handling of the season fan-out (see operators.skew)."""

    rows_per_task: int = 250_000  # rows (listings x seasons) that one part of a code gives


@dataclass(frozen=True)
class MatchRules:
    """Readings of the reference's unspecified matching and removal rules
    (SURVEY §7, open questions); defaults reproduce the fixtures' counts."""

    own_only: bool = True  # the host's id must be on an own row
    active_only: bool = False  # ...that is flagged active (if the table says)
    on_data_date: bool = False  # ...and effective on the run's data date
    deactivate_removed: bool = False  # removed compset rows: flag off, not delete


class Reconciliation(Mapping[str, DataFrame]):
    """All intermediate and final outputs of one run, keyed by query name.

    ``t`` holds ``listing`` (the feed) and the reference tables ``property``,
    ``compset``, ``competitor``, ``season_map``, ``run_pin``, ``comp_config``.
    ``stage(name, df)`` is called on every shared intermediate (``codes``,
    ``tagged``, ``new_hosts``, ``competitor_upserts``, ``compset_diff``,
    ``desired_config``, ``config_pairs``, ``config_inserts``, ``config_deletes``, ``config_updates``); the staged run
    writes them once and reads them back, as the registered queries do with those that
    they read several times; without it they stay lazy.  ``admitted`` holds new-host rows the caller has already added to
    ``t["compset"]`` (same-run admission); they are reported as this run's new
    hosts and not inserted again.  ``key_ranges`` above 0 reads the config only in so many
    ranges of the feed's codes for the change sets (see :mod:`feedsync.sources.clustered`).

    Not thread-safe: build the views a run needs before handing them to
    concurrent writers.
    """

    # query name -> attribute; names starting with "_" are internal
    NAMES = (
        "feed_scan", "derive_id_name", "valid_codes", "malformed_codes", "host_counts",
        "non_single_hosts", "single_host_rows", "duplicate_host_report", "with_property",
        "missing_property_report", "host_state", "matched_rows", "id_mismatch_report", "new_hosts",
        "rename_records", "renamed_hosts", "renamed_listings", "competitor_upserts", "compset_diff",
        "compset_after", "compset_rejected", "compset_history", "competitor_after", "pinned_seasons", "desired_config",
        "config_inserts", "config_deletes", "config_deletes_matched", "config_updates", "config_change_set",
        "config_after",
        "touched_properties", "compset_seasons", "competitor_rejected", "_report_rows", "_all_reports",
        "_config_rejected",
    )

    def __init__(
        self,
        t: dict[str, DataFrame],
        ctx: RunContext | None = None,
        skew: SkewConf | None = None,
        scope: str = "valid",
        stage: Stage = lazy,
        admitted: DataFrame | None = None,
        rules: MatchRules | None = None,
        defaults: Mapping[str, object] | None = None,
        key_ranges: int = 0,
    ) -> None:
        self.rules = rules or MatchRules()
        self.defaults = defaults
        self.key_ranges = key_ranges
        self.t = t
        self.ctx = ctx or RunContext()
        self.skew = skew or SkewConf()
        self.scope = scope
        self.stage = stage
        self.admitted = admitted
        self._overrides: dict[str, DataFrame] = {}

    # Mapping interface -----------------------------------------------------
    def __getitem__(self, name: str) -> DataFrame:
        if name in self._overrides:
            return self._overrides[name]
        if name not in self.NAMES:
            raise KeyError(name)
        return getattr(self, name.lstrip("_"))

    def __setitem__(self, name: str, df: DataFrame) -> None:
        self._overrides[name] = df

    def __iter__(self) -> Iterator[str]:
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)

    @property
    def stamp_with(self) -> tuple[str, object]:
        return (self.ctx.user, self.ctx.run_ts)

    def over(self, **tables: DataFrame) -> Reconciliation:
        """The same run with other current states below its next states.  Change sets
        and everything else that is built already stay, so build them first."""
        other = copy.copy(self)
        other.t = {**self.t, **tables}
        for name in ("_compset_applied", "compset_after", "compset_rejected", "competitor_after", "_config_applied",
                     "config_after", "config_rejected"):
            other.__dict__.pop(name, None)
        return other

    # trunk -----------------------------------------------------------------
    @cached_property
    def feed_scan(self) -> DataFrame:
        return self.t["listing"].select(*FEED_COLUMNS)

    @cached_property
    def checked(self) -> DataFrame:
        # row-local derivation (B03, B04): recomputed from the (staged or
        # Parquet) feed rather than written again
        return check_codes(derive(self.feed_scan))

    @cached_property
    def groups(self) -> DataFrame:
        valid = self.checked.filter(F.col("code_ok")).drop("code_ok")
        return host_groups(valid)

    @cached_property
    def codes(self) -> DataFrame:
        r = self.rules
        codes = classify_codes(
            self.groups,
            self.t["property"],
            self.t["compset"],
            own_only=r.own_only,
            active_only=r.active_only,
            on_date=self.ctx.data_date if r.on_data_date else None,
        )
        # the rows a code fans out to: its listings times its pinned seasons
        n_list = F.col("n_host") + F.col("n_comp")
        codes = codes.join(season_counts(self.pinned), "prop_code", "left").withColumn(
            "n_fan", n_list * F.coalesce("n_season", F.lit(0))
        )
        return self.stage("codes", codes.withColumn("n_season", F.coalesce("n_season", F.lit(0))))

    @cached_property
    def tagged(self) -> DataFrame:
        summary = self.codes.select("prop_code", "n_host", "host_id", "state", "n_fan", "n_season")
        return self.stage("tagged", tag_rows(self.checked, summary))

    # B03, B04 ----------------------------------------------------------------
    @cached_property
    def derive_id_name(self) -> DataFrame:
        return self.checked.select(*FEED_COLUMNS, "competitor_id", "competitor_name")

    @cached_property
    def valid_codes(self) -> DataFrame:
        return self.checked.filter(F.col("code_ok")).select(*FEED_COLUMNS, "prop_code")

    @cached_property
    def malformed_codes(self) -> DataFrame:
        return self.checked.filter(~F.col("code_ok")).select(*FEED_COLUMNS)

    # B05 -------------------------------------------------------------------
    @cached_property
    def host_counts(self) -> DataFrame:
        return self.codes.select("prop_code", "n_host", "n_comp")

    @cached_property
    def non_single_hosts(self) -> DataFrame:
        return self.codes.filter(F.col("n_host") != 1).select("prop_code", "n_host", "n_comp")

    @cached_property
    def single(self) -> DataFrame:
        return self.tagged.filter(F.col("code_ok") & (F.col("state") != F.lit(NON_SINGLE)))

    @cached_property
    def single_host_rows(self) -> DataFrame:
        return self.single.select(*ROW_COLS)

    # B07, B08 --------------------------------------------------------------
    @cached_property
    def state(self) -> DataFrame:
        return self.codes.filter(F.col("state") != F.lit(NON_SINGLE)).select("prop_code", "host_id", "state")

    @cached_property
    def host_state(self) -> DataFrame:
        return self.state.filter(F.col("state") != F.lit(NO_PROPERTY))

    @cached_property
    def with_property(self) -> DataFrame:
        return self.single.filter(F.col("state") != F.lit(NO_PROPERTY)).select(*ROW_COLS)

    @cached_property
    def matched(self) -> DataFrame:
        return self.single.filter(F.col("state") == F.lit(MATCH))

    @cached_property
    def matched_rows(self) -> DataFrame:
        return self.matched.select(*ROW_COLS)

    # B06, B07, B09 reports ---------------------------------------------------
    @cached_property
    def report_rows(self) -> DataFrame:
        return reports_from_tags(self.tagged)

    @cached_property
    def all_reports(self) -> DataFrame:
        """Malformed rows and the rows of the three reports, tagged, from one scan."""
        return reports_from_tags(self.tagged, malformed=True)

    @cached_property
    def duplicate_host_report(self) -> DataFrame:
        return tagged_report(self.tagged, DUPLICATE_HOST)

    @cached_property
    def missing_property_report(self) -> DataFrame:
        return tagged_report(self.tagged, MISSING_PROPERTY)

    @cached_property
    def id_mismatch_report(self) -> DataFrame:
        return tagged_report(self.tagged, ID_MISMATCH)

    # B10 -------------------------------------------------------------------
    @cached_property
    def new_hosts(self) -> DataFrame:
        if self.admitted is not None:
            return self.admitted
        return self.stage("new_hosts", new_hosts(self.state, self.ctx.run_ts))

    # B11, B12 --------------------------------------------------------------
    @cached_property
    def rename_records(self) -> DataFrame:
        return rename_records(self.checked, self.t["competitor"])

    @cached_property
    def renamed(self) -> DataFrame:
        return rename_listings(self.matched, self.rename_records)

    @cached_property
    def renamed_listings(self) -> DataFrame:
        return self.renamed.filter(F.col("renamed")).select("prop_code", "role", "competitor_id", "competitor_name")

    @cached_property
    def renamed_hosts(self) -> DataFrame:
        return renamed_hosts(self.matched, self.rename_records)

    @cached_property
    def competitor_upserts(self) -> DataFrame:
        rows = competitor_upserts(
            self.competitor_pairs, self.t["competitor"], self.renamed_hosts, self.ctx.user, self.ctx.run_ts
        )
        return self.stage("competitor_upserts", rows)

    @cached_property
    def competitor_pairs(self) -> DataFrame:
        return renamed_pairs(self.matched, self.rename_records)

    @cached_property
    def competitor_rejected(self) -> DataFrame:
        return split_named(self.competitor_pairs)[1]

    # B13 and B17 on the compset and competitor tables ------------------------
    @cached_property
    def compset_diff(self) -> DataFrame:
        return self.stage("compset_diff", compset_diff(self.matched, self.t["compset"], self.state))

    @cached_property
    def _compset_applied(self) -> tuple[DataFrame, DataFrame]:
        cdiff = self.compset_diff
        # hosts admitted by the caller are already part of the compset
        hosts = self.new_hosts if self.admitted is None else self.admitted.limit(0)
        ins = (
            cdiff.filter(F.col("change") == "insert")
            .select(*PAIR_KEYS)
            .withColumn("own_ind", F.lit(NOT_OWN_FLAG))
            .unionByName(hosts.select(*PAIR_KEYS, "own_ind"))
        )
        if "active_ind" in self.t["compset"].columns:
            ins = ins.withColumn("active_ind", F.lit(OWN_FLAG))  # new rows are active
        dele = cdiff.filter(F.col("change") == "delete").select(*PAIR_KEYS)
        apply = deactivate_changes if self.rules.deactivate_removed else apply_changes
        own = F.col("own_ind") == F.lit(OWN_FLAG)  # own rows are never removed here
        after, rejected = apply(self.t["compset"], ins, dele, PAIR_KEYS, stamp_with=self.stamp_with, keep=own)
        return after, rejected.select("prop_code", "competitor_id", "own_ind")

    @cached_property
    def compset_after(self) -> DataFrame:
        return self._compset_applied[0]

    @cached_property
    def compset_rejected(self) -> DataFrame:
        return self._compset_applied[1]

    @cached_property
    def compset_history(self) -> DataFrame:
        """The compset as date ranges: changes are taken against the pairs in force on the
        data date, so a pair whose range has ended opens a new one."""
        on = self.ctx.data_date
        changes = compset_diff(self.matched, current_rows(self.t["compset"], on_date=on), self.state)
        changes = self.stage("history_changes", changes)
        hosts = self.new_hosts if self.admitted is None else self.admitted.limit(0)
        return apply_history(self.t["compset"], changes, hosts, on)

    @cached_property
    def competitor_after(self) -> DataFrame:
        return upsert(self.t["competitor"], self.competitor_upserts, ["competitor_id"], self.stamp_with)

    # B14, B15 (names do not enter the config, so the rename join is not on
    # this path) ----------------------------------------------------------------
    @cached_property
    def pinned(self) -> DataFrame:
        return pin_runs(self.t["season_map"], self.t["run_pin"])

    @cached_property
    def pinned_seasons(self) -> DataFrame:
        return self.pinned.select("prop_code", "run_id", "season_id", "we_ind")

    def _expanded(self, rows: DataFrame, fan: DataFrame) -> DataFrame:
        return expand_seasons(rows, self.pinned, fan, self.skew.rows_per_task)

    @cached_property
    def desired_config(self) -> DataFrame:
        rows = self.matched.withColumn("own_ind", own_flag(F.col("is_host")))
        return self.stage("desired_config", self._expanded(rows, self.codes.filter(F.col("state") == F.lit(MATCH))))

    @cached_property
    def compset_seasons(self) -> DataFrame:
        c = self.ctx
        return season_rows(self.desired_config, c.run_id, c.data_date, c.user, c.run_ts)

    # B16, B17, B20 -------------------------------------------------------------
    @cached_property
    def config_in_scope(self) -> DataFrame:
        """Stored config rows of the feed's valid codes; no other row can change."""
        config = self.t["comp_config"]
        return scoped(config, self.codes, "prop_code", self.key_ranges) if self.key_ranges else config

    @cached_property
    def config_pairs(self) -> DataFrame:
        return self.stage("config_pairs", config_pairs(self.matched, self.config_in_scope))

    @cached_property
    def config_inserts(self) -> DataFrame:
        roles = F.array(F.when(F.col("is_own"), own_flag(F.lit(True))), F.when(F.col("is_comp"), own_flag(F.lit(False))))
        rows = self.config_pairs.filter(F.col("change") == "insert").withColumn(
            "own_ind", F.explode(F.array_compact(roles))
        )
        fan = self.codes.filter(F.col("state") == F.lit(MATCH))
        if self.stage is not lazy:
            # the pairs are staged: seasons of codes without an inserted pair never move
            # (lazily this would evaluate the pairs' join once more)
            fan = rows.groupBy("prop_code").agg(F.max("n_fan").alias("n_fan"), F.max("n_season").alias("n_season"))
        return self.stage("config_inserts", self._expanded(rows, fan))

    def _deletes_in(self, scope: str) -> DataFrame:
        # every valid code is a row of ``codes``
        codes = self.codes
        if scope == "matched":
            codes = codes.filter((F.col("state") == F.lit(MATCH)) & (F.col("n_fan") > 0))
        elif scope != "valid":
            raise ValueError(f"unknown scope {scope!r}")
        gone = self.config_pairs.filter(F.col("change") == "delete").select(*PAIR_KEYS)
        return gone.join(codes.select("prop_code"), "prop_code", "left_semi")

    @cached_property
    def config_deletes(self) -> DataFrame:
        return self.stage("config_deletes", self._deletes_in(self.scope))

    @cached_property
    def config_deletes_matched(self) -> DataFrame:
        return self._deletes_in("matched")

    @cached_property
    def config_updates(self) -> DataFrame:
        return self.stage("config_updates", config_updates(self.config_in_scope, self.config_pairs, self.pinned))

    @cached_property
    def config_change_set(self) -> DataFrame:
        return change_set(self.config_in_scope, self.config_inserts, self.config_deletes, self.config_updates)

    @cached_property
    def _config_applied(self) -> tuple[DataFrame, DataFrame]:
        updated = apply_updates(
            self.t["comp_config"],
            self.config_updates,
            [*PAIR_KEYS, "season_id"],
            {"we_ind": ("we_before", "we_after"), "own_ind": ("own_before", "own_after")},
            self.stamp_with,
            by=PAIR_KEYS,  # as the deletes below
        )
        after, rejected = apply_changes(
            updated, self.config_inserts, self.config_deletes, stamp_with=self.stamp_with, defaults=self.defaults
        )
        return after, rejected.select(*self.config_inserts.columns)

    @cached_property
    def config_after(self) -> DataFrame:
        return self._config_applied[0]

    @cached_property
    def config_rejected(self) -> DataFrame:
        return self._config_applied[1]

    @cached_property
    def touched_properties(self) -> DataFrame:
        # rejected inserts change nothing
        keyed = F.col("prop_code").isNotNull() & F.col("competitor_id").isNotNull()
        inserted = self.config_pairs.filter((F.col("change") == "insert") & keyed)
        return touched(inserted, self.config_deletes, self.config_updates).select("prop_code", "pgm_code")


def reconcile_views(
    t: dict[str, DataFrame],
    ctx: RunContext | None = None,
    skew: SkewConf | None = None,
    scope: str = "valid",
    stage: Stage = lazy,
    admitted: DataFrame | None = None,
    rules: MatchRules | None = None,
    defaults: Mapping[str, object] | None = None,
    key_ranges: int = 0,
) -> Reconciliation:
    """The run's views (see :class:`Reconciliation`); nothing is built until used.
    ``defaults`` are config values of inserted rows, e.g. weights."""
    return Reconciliation(t, ctx, skew, scope, stage, admitted, rules, defaults, key_ranges)
