"""The operators on the generic tables.

``events`` play the observations of a stay: a stay is the span of one user's events, in whole hours so that
events often fall on a grid line, cut 37 hours before the last event so that some lie outside. ``orders``
and ``lineitem`` play admissions and their records, ``part`` the code dictionary.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidespan.functions import scoring
from tidespan.functions.temporal import age_at, days_between, died_within, plus_hours, truncate_hour
from tidespan.functions.text import classify_text, first_match, in_list, matches_any
from tidespan.operators.asof import asof_backward, carry_previous
from tidespan.operators.bins import (
    assign_bins,
    bin_aggregate,
    bins_with_lookback,
    covered_bins,
    lookback_bins,
    overlapped_bins,
)
from tidespan.operators.codebook import code_book_flags
from tidespan.operators.codes import CodeRule, code_flags
from tidespan.operators.episodes import episode_features, state_episodes
from tidespan.operators.exact import exact_aggregate
from tidespan.operators.intervals import interval_join, points_in_windows
from tidespan.operators.outer import full_outer_distinct, full_outer_grid, keep_groups
from tidespan.operators.pivot import Measure, guarded_pivot
from tidespan.operators.ranking import dense_rank_by_time, earliest_by_time, first_per_key, smallest_time
from tidespan.operators.spine import time_spine
from tidespan.sources.registry import Sources, materialize, shared_folder
from tidespan.sources.snapshots import read_where, write_snapshot

TYPES = ("click", "error", "purchase", "signup", "view")
LOOKBACK = ("error", "purchase", "signup")
USER = ["user_id"]
BIN = ["user_id", "bin_index"]


def r6(c: str, name: str | None = None) -> str:
    return f"round({c}, 6) AS {name or c}"


def group(df: DataFrame, keys: list[str], *aggs: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(a) for a in aggs])


class Generic:
    """Frames shared by the queries over one set of generic tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, hot_rows: int | None = None, chunk_seconds: int = 6 * 3600):
        """``hot_rows`` lowers the threshold of heavy keys, so that all keys of a small table are heavy."""
        self.table = Sources(spark, sf_dir)
        self.salts = {"hot_rows": hot_rows} if hot_rows else {}
        self.heavy = self.salts | ({"chunk_seconds": chunk_seconds} if hot_rows else {})

    def events(self, *types: str) -> DataFrame:
        ev = self.table("events")
        ev = ev.filter(in_list("event_type", types)) if types else ev
        return ev.selectExpr("*", f"{truncate_hour('ts')} AS th")

    def stays(self) -> DataFrame:
        return group(self.events(), USER, "min(th) AS stay_start", f"{plus_hours('max(th)', -37)} AS stay_end")

    def spine(self) -> DataFrame:
        return time_spine(self.stays(), "stay_start", "stay_end", columns=USER)

    def on_spine(self, features: DataFrame) -> DataFrame:
        return self.spine().join(features, BIN, "left")

    # --- scans, filters, joins -------------------------------------------------------------------
    def code_prefilter_scan(self) -> DataFrame:
        kept = self.table("events").filter(in_list("event_type", ("error", "view", "purchase")))
        return group(kept, ["event_type"], "count(1) AS n", "round(sum(value), 2) AS total")

    def code_prefilter_clustered(self) -> DataFrame:
        """The same from a copy whose files lie along a curve over type, user and time."""
        path = f"{shared_folder(self.table.spark)}/tidespan/clustered-{uuid.uuid4().hex}"
        write_snapshot(self.table("events"), path, cluster_by=["event_type", "user_id", "ts"])
        kept = read_where(self.table.spark, path, {"event_type": ["error", "view", "purchase"]})
        return exact_aggregate(kept, ["event_type"], {"total": "value"}, {"mean": "value"})

    def dim_label_filter(self) -> DataFrame:
        wanted = self.table("part").filter(matches_any("p_name", ("widget", "ring"))).selectExpr("p_partkey AS key", "p_name")
        lines = self.table("lineitem").selectExpr("l_partkey AS key", "l_quantity")
        return group(lines.join(wanted, "key"), ["p_name"], "count(1) AS n", "round(sum(l_quantity), 2) AS quantity")

    def category_map(self) -> DataFrame:
        label = first_match([
            (in_list("o_orderpriority", ("1-URGENT", "2-HIGH")), "postSurgical "),
            (in_list("o_orderpriority", ("5-LOW",)), "intensiveCare"),
        ])
        return self.table("orders").selectExpr("o_orderkey", f"{label} AS category")

    def text_flag_by_subject(self) -> DataFrame:
        flags = group(self.table("orders").withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"],
                      "max(CASE WHEN o_orderpriority LIKE '%URGENT%' THEN 1 ELSE 0 END) AS urgent")
        return self.table("customer").select("c_custkey").join(flags, "c_custkey", "left")

    def order_lines(self, *columns: str) -> DataFrame:
        orders = self.table("orders").selectExpr("o_orderkey AS key", "*")
        lines = self.table("lineitem").selectExpr("l_orderkey AS key", "*")
        return orders.join(lines, "key").select(*columns)

    def stay_outcomes(self) -> DataFrame:
        rows = self.order_lines("o_orderkey", "o_orderdate", "l_linenumber", "l_shipdate")
        return rows.selectExpr(
            "o_orderkey",
            f"{days_between('l_shipdate', 'o_orderdate')} AS los_day",
            f"{died_within('l_shipdate', 'o_orderdate', 28)} AS within28",
            f"{died_within('l_shipdate', 'o_orderdate', 90)} AS within90",
            f"round({age_at('l_linenumber + 20', '1995', 'o_orderdate')}) AS age",
        )

    def cohort_first_stay(self) -> DataFrame:
        # only rank 1 is asked for: the smallest time per key will do, and lines are joined to the first orders alone
        lines = self.table("lineitem").selectExpr("l_orderkey AS o_orderkey", "l_shipdate")
        shipped = group(lines, ["o_orderkey"], f"{smallest_time('l_shipdate')} AS _first")
        orders = self.table("orders").select("o_custkey", "o_orderkey", "o_orderdate").join(shipped, "o_orderkey")
        first = earliest_by_time(orders, ["o_custkey"], "o_orderdate")
        return first.join(lines, "o_orderkey").filter("l_shipdate <=> _first").selectExpr(
            "o_custkey", "o_orderkey", "o_orderdate", "l_shipdate", "1L AS hospstay_seq", "1L AS icustay_seq")

    def order_ranks(self) -> DataFrame:
        """All ranks of the orders of a customer by date."""
        rows = self.table("orders").select("o_custkey", "o_orderkey", "o_orderdate")
        return dense_rank_by_time(rows, ["o_custkey"], "o_orderdate", "hospstay_seq")

    def window_avg_ratio(self) -> DataFrame:
        orders = self.table("orders").selectExpr("o_orderkey AS order_key", "o_orderdate")
        lines = self.table("lineitem").selectExpr("l_orderkey AS order_key", "l_shipdate", "l_extendedprice", "l_quantity")
        inside = points_in_windows(lines, orders, ["order_key"], "l_shipdate", plus_hours("o_orderdate", -30 * 24),
                                   plus_hours("o_orderdate", 90 * 24), whole_cells=False)
        means = group(inside, ["order_key"], "avg(l_extendedprice) AS p", "avg(l_quantity) AS q")
        return orders.select("order_key").join(means, "order_key", "left").selectExpr(
            "order_key", r6("p", "weight"), r6("q", "height"), r6(scoring.safe_ratio("p", "pow(q / 10, 2)"), "ratio")
        )

    def subject_left_joins(self) -> DataFrame:
        totals = group(self.table("orders").withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"],
                       "count(1) AS n_orders", "round(sum(o_totalprice), 2) AS total")
        nation = self.table("nation").withColumnRenamed("n_nationkey", "c_nationkey")
        region = self.table("region").withColumnRenamed("r_regionkey", "n_regionkey")
        return (
            self.table("customer").select("c_custkey", "c_nationkey")
            .join(totals, "c_custkey", "left").join(nation, "c_nationkey", "left").join(region, "n_regionkey", "left")
            .select("c_custkey", "n_orders", "total", "n_name", "r_name")
        )

    # --- codes and text --------------------------------------------------------------------------
    BRAND_RULES = {
        "f_prefix": [CodeRule(None, 7, ("Brand#1",))],
        "f_list": [CodeRule(None, None, ("Brand#12", "Brand#23"))],
        "f_range": [CodeRule(None, 8, ranges=(("Brand#13", "Brand#19"),))],
        "f_version": [CodeRule(1, 7, ("Brand#2",)), CodeRule(0, 8, ("Brand#3", "Brand#5"))],
        "f_short_range": [CodeRule(0, 7, ranges=(("Brand#3", "Brand#5"),))],
    }

    def coded_lines(self, *columns: str) -> DataFrame:
        part = self.table("part").selectExpr("p_partkey AS key", *columns)
        return self.table("lineitem").selectExpr("l_orderkey", "l_partkey AS key").join(part, "key")

    def code_flags(self) -> DataFrame:
        coded = self.coded_lines("p_brand", "p_size % 2 AS version")
        return code_flags(coded, ["l_orderkey"], "p_brand", "version", self.BRAND_RULES)

    @staticmethod
    def code_book() -> dict[str, list[CodeRule]]:
        """5,000 rules for 40 flags: ranges of four hexadecimal digits, a third of them for one version alone."""
        book = {f"b{flag}": [] for flag in range(40)}
        for i in range(5000):
            low = i * 7919 % 65536
            book[f"b{i % 40}"].append(CodeRule(i % 2 if i % 3 == 0 else None, 4, ranges=((f"{low:04X}", f"{min(65535, low + i % 7):04X}"),)))
        return book

    def code_book_flags(self) -> DataFrame:
        code = "lpad(hex(pmod(l_partkey * 2654435761, 4294967296)), 8, '0')"
        return code_book_flags(self.table("lineitem"), ["l_orderkey"], code, "l_partkey % 2", self.code_book(), **self.salts)

    def weighted_index(self) -> DataFrame:
        return self.code_flags().selectExpr(
            "l_orderkey",
            "f_prefix + greatest(f_list, 3 * f_range) + greatest(2 * f_version, f_short_range) AS index",
        )

    def text_classifier(self) -> DataFrame:
        rules = [("fastener", ["bolt", "ring"]), ("small tool", [("small", "gizmo"), "small gear"]), ("plain", ["gear", "plate"])]
        return self.table("part").selectExpr("p_partkey", f"{classify_text('p_name', rules, 'other')} AS class")

    def text_max_label(self) -> DataFrame:
        return group(self.coded_lines("p_name", "p_type"), ["l_orderkey", "p_type"], "max(p_name) AS label")

    # --- pivots and aggregates -------------------------------------------------------------------
    def union_pivot_rates(self) -> DataFrame:
        value = "CASE WHEN event_type = 'view' AND value < 1 THEN value * 60 ELSE value END"
        rates = group(self.events(*TYPES), ["user_id", "th"],
                      *[f"max(CASE WHEN event_type = '{t}' THEN {value} END) AS rate_{t}" for t in TYPES])
        weights = {"rate_error": 1.0, "rate_view": 0.01, "rate_click": 8.33, "rate_purchase": 0.01, "rate_signup": 1.0}
        return rates.selectExpr("*", r6(scoring.weighted_sum(weights), "rate_total"))

    def sum_by_time(self) -> DataFrame:
        return group(self.events("click", "view", "signup"), ["user_id", "th"], "round(sum(value), 2) AS output")

    MEASURES = (
        Measure("error", ("error",), 0, 100),
        Measure("seen", ("view", "signup"), 50, 400),
        Measure("temp", ("click",), 70, 120, convert="({v} - 32) / 1.8D"),
        Measure("temp", ("purchase",), 10, 50, closed_high=True),
    )

    def guarded_pivot(self) -> DataFrame:
        wide = guarded_pivot(self.events(), ["user_id", "th"], self.MEASURES, "event_type", "value")
        return wide.selectExpr("user_id", "th", *[r6(c) for c in ("error", "seen", "temp")])

    def group_by_measure(self) -> DataFrame:
        rows = self.table("events").selectExpr(
            "user_id", "cast(ts AS date) AS day", "event_type", "cast(floor(value / 50) AS bigint) AS band", "value")
        return group(rows, ["user_id", "day", "event_type", "band"], r6("avg(value)", "mean"), "count(1) AS n")

    def exact_totals(self) -> DataFrame:
        """Sum and average per type to the last bit, in any order of the rows."""
        return exact_aggregate(self.table("events"), ["event_type"], {"total": "value"}, {"mean": "value"})

    # --- ordered operators -----------------------------------------------------------------------
    def asof_fallback(self) -> DataFrame:
        kinds = ("view", "click")
        latest = group(self.events(*kinds), ["user_id", "ts"], *[
            f"CASE WHEN count_if(event_type = '{k}') > 0 THEN named_struct('v', avg(CASE WHEN event_type = '{k}' THEN value END)) END AS {k}" for k in kinds])
        probes = self.events("error").select("event_id", "user_id", "ts", "value")
        found = asof_backward(probes, latest, USER, "ts", 48, count_on=self.table("events"), **self.heavy)
        return found.selectExpr(
            "event_id", "user_id", "ts", "view", "click",
            "coalesce(CASE WHEN value < 100 THEN value END, view, click) AS filled",
        )

    def carry_previous(self) -> DataFrame:
        rows = self.table("events").selectExpr(
            "event_id", "user_id", "ts", "CASE WHEN event_type <> 'click' THEN value END AS score")
        carried = carry_previous(rows, USER, "ts", ["score"], 6, tie=["event_id"], **self.heavy)
        return carried.selectExpr("*", "coalesce(score, prev_score, 6D) AS filled")

    def full_outer_distinct(self) -> DataFrame:
        clicks = self.events("click").selectExpr("user_id", "th", "cast(floor(value / 100) AS bigint) AS click")
        views = group(self.events("view"), ["user_id", "th"], "max(value) AS view")
        return full_outer_distinct(clicks, views, ["user_id", "th"])

    def full_outer_grid(self) -> DataFrame:
        sides = [self.events(t).selectExpr("user_id", f"th AS {t}_time", f"cast(floor(value / 100) AS bigint) AS {t}") for t in ("signup", "error")]
        return full_outer_grid(*sides, USER, **({"cell_rows": self.salts["hot_rows"]} if self.salts else {}))

    def priority_row_number(self) -> DataFrame:
        rows = self.table("events").selectExpr("event_id", "user_id", "cast(ts AS date) AS day", "event_type", "value")
        return first_per_key(rows, ["user_id", "day"],
                             "event_type DESC NULLS LAST, value ASC NULLS LAST, event_id DESC NULLS LAST")

    def first_service(self) -> DataFrame:
        turns = self.table("conversations").select("conv_id", "turn", "role")
        return first_per_key(turns, ["conv_id"], "turn ASC NULLS FIRST, role ASC NULLS LAST")

    def distinct_on_first(self) -> DataFrame:
        rows = self.table("events").filter("value > 150").select("user_id", "ts", "event_id", "value")
        return first_per_key(rows, USER, "ts ASC NULLS LAST, event_id ASC")

    # --- bins ------------------------------------------------------------------------------------
    def time_spine(self) -> DataFrame:
        return self.spine()

    def means(self) -> DataFrame:
        """Mean value per type and bin, only bins with events."""
        events = self.events(*TYPES).select("user_id", "th", "event_type", "value")
        return bin_aggregate(events, self.stays(), USER, "th", "stay_start", "stay_end",
                             [f"avg(CASE WHEN event_type = '{t}' THEN value END) AS {t}" for t in TYPES])

    def bin_avg(self) -> DataFrame:
        return self.on_spine(self.means()).selectExpr("user_id", "bin_start", *[r6(t) for t in TYPES])

    def exact_bin_avg(self) -> DataFrame:
        events = self.events(*TYPES).select("user_id", "th", "event_type", "value")
        binned = assign_bins(events, self.stays(), USER, "th", "stay_start", "stay_end")
        means = exact_aggregate(binned, BIN, means={t: f"CASE WHEN event_type = '{t}' THEN value END" for t in TYPES})
        return self.on_spine(means).select("user_id", "bin_start", *TYPES)

    def bin_any_flag(self) -> DataFrame:
        events = self.events("error").select("user_id", "th")
        flags = bin_aggregate(events, self.stays(), USER, "th", "stay_start", "stay_end", ["max(1) AS any_error"])
        return self.on_spine(flags).selectExpr("user_id", "bin_start", "coalesce(any_error, 0) AS any_error")

    def bin_distinct_list(self) -> DataFrame:
        """Sorted distinct types per bin; duplicates go first, so a list is as long as the vocabulary at most."""
        events = self.events(*LOOKBACK).select("user_id", "th", "event_type")
        binned = assign_bins(events, self.stays(), USER, "th", "stay_start", "stay_end")
        labels = group(binned.select(*BIN, "event_type").distinct(), BIN,
                       "listagg(event_type, ', ') WITHIN GROUP (ORDER BY event_type) AS labels")
        return self.on_spine(labels).select("user_id", "bin_start", "labels")

    def intervals(self, *types: str, more: tuple[str, ...] = ()) -> DataFrame:
        """Event as interval of 0–29 hours; every tenth has no end."""
        stop = "CASE WHEN event_id % 10 <> 0 THEN th + (cast(floor(value) AS bigint) % 30) * INTERVAL '1' HOUR END"
        return self.events(*types).selectExpr("user_id", "event_type", "th", f"{stop} AS stop", *more)

    def overlaps(self) -> DataFrame:
        """Bins that any purchase interval touches; of equal starts only the longest interval matters."""
        events = self.intervals("purchase")
        spans = group(events, ["user_id", "th"], "max(stop) AS stop")
        hits = covered_bins(spans, self.stays(), USER, "th", "stop", "stay_start", "stay_end", USER, count_on=events,
                            apart=["user_id", "th"], **self.salts)
        return hits.selectExpr(*BIN, "1 AS overlap")

    def interval_overlap_flag(self) -> DataFrame:
        return self.on_spine(self.overlaps()).selectExpr("user_id", "bin_start", "coalesce(overlap, 0) AS overlap")

    def interval_overlap_pairs(self) -> DataFrame:
        """Purchases and errors of a user, both as intervals, that overlap."""
        sides = [self.intervals(t, more=("event_id",)).selectExpr("user_id", f"event_id AS {t}_id", f"th AS {t}_start", f"stop AS {t}_stop") for t in ("purchase", "error")]
        pairs = interval_join(*sides, USER, ("purchase_start", "purchase_stop"), ("error_start", "error_stop"))
        return pairs.selectExpr("user_id", "purchase_id", "error_id", "greatest(purchase_start, error_start) AS starttime", "least(purchase_stop, error_stop) AS stoptime")

    def lookbacks(self, active_until: str | None) -> DataFrame:
        hits = lookback_bins(self.intervals(*LOOKBACK), self.stays(), USER, "th", "stay_start", "stay_end", active_until)
        flags = group(hits, BIN, *[f"max(CASE WHEN event_type = '{t}' THEN 1 END) AS {t}_24h" for t in LOOKBACK])
        return self.on_spine(flags).selectExpr(
            "user_id", "bin_start", *[f"coalesce({t}_24h, 0) AS {t}_24h" for t in LOOKBACK])

    def lookback_flags(self) -> DataFrame:
        return self.lookbacks(None)

    def lookback_still_active(self) -> DataFrame:
        return self.lookbacks(f"coalesce(stop, {plus_hours('th', 1)})")

    def features(self) -> DataFrame:
        """Means, any-flag, label list and look-back flags of every bin: one scan, one join, one aggregate."""
        events = self.events(*TYPES).select("user_id", "th", "event_type", "value")
        hits = bins_with_lookback(events, self.stays(), USER, "th", "stay_start", "stay_end")
        wide = group(
            hits, BIN,
            *[f"avg(CASE WHEN in_bin AND event_type = '{t}' THEN value END) AS {t}" for t in TYPES],
            *[f"max(CASE WHEN NOT in_bin AND event_type = '{t}' THEN 1 END) AS {t}_24h" for t in LOOKBACK],
        )
        present = ", ".join(f"CASE WHEN {t} IS NOT NULL THEN '{t}' END" for t in sorted(LOOKBACK))
        return wide.selectExpr(
            "*", "CASE WHEN error IS NOT NULL THEN 1 END AS any_error", f"nullif(concat_ws(', ', {present}), '') AS labels")

    FLAGS = ("any_error", "overlap", "error_24h", "purchase_24h", "signup_24h")

    def binned(self, *totals: str) -> DataFrame:
        """Spine with every feature; all three frames are partitioned by (user_id, bin_index).

        ``totals`` are further aggregates of a user's events; the spine carries them to the bins.
        """
        stays = group(self.events(), USER, "min(th) AS stay_start", f"{plus_hours('max(th)', -37)} AS stay_end", *totals)
        names = [t.rsplit(" AS ", 1)[1] for t in totals]
        spine = time_spine(stays, "stay_start", "stay_end", columns=[*USER, *names])
        rows = spine.join(self.features(), BIN, "left").join(self.overlaps(), BIN, "left")
        return rows.selectExpr("user_id", "bin_start", *names, *TYPES, "labels", *[f"coalesce({n}, 0) AS {n}" for n in self.FLAGS])

    def flag_union_join(self) -> DataFrame:
        return self.binned().select("user_id", "bin_start", *self.FLAGS, "labels")

    # --- episodes --------------------------------------------------------------------------------
    def runs(self, keep: list[str] | None = None) -> DataFrame:
        rows = self.table("events").select("user_id", "ts", "event_type")
        return state_episodes(rows, USER, "ts", "event_type", keep=keep, **self.heavy)

    def state_episodes(self) -> DataFrame:
        return self.runs()

    def episodes(self, stays: DataFrame) -> DataFrame:
        """View episodes that start inside the stay, with their descriptors."""
        inside = self.runs(["view"]).drop("event_type").join(stays, "user_id")
        return episode_features(inside.filter("starttime BETWEEN stay_start AND stay_end"), USER)

    def episode_features(self) -> DataFrame:
        return self.episodes(self.stays())

    def episode_bins(self) -> DataFrame:
        stays = self.stays()
        episodes = self.episodes(stays).select("user_id", "starttime", "endtime", "num_event")
        return overlapped_bins(episodes, stays, USER, "starttime", "endtime", "stay_start", "stay_end",
                               reach_minutes=239, count_on=self.table("events"), apart=["user_id", "starttime"], **self.salts).select(*BIN, "starttime", "endtime", "num_event")

    def episode_bin_overlap(self) -> DataFrame:
        return self.on_spine(self.episode_bins()).select("user_id", "bin_start", "starttime", "endtime", "num_event")

    def rule_cascade_flag(self) -> DataFrame:
        rows = self.on_spine(self.means()).join(self.episode_bins(), BIN, "left")
        incomplete = "(error IS NULL OR view IS NULL OR click IS NULL)"
        flag = f"""CASE WHEN starttime IS NULL THEN 0
            WHEN NOT {incomplete} THEN 1
            WHEN {incomplete} AND num_event = 1 THEN 1
            WHEN num_event > 1 AND coalesce(error, click) IS NOT NULL AND view IS NOT NULL THEN 1
            ELSE 0 END"""
        return rows.selectExpr("user_id", "bin_start", "starttime", f"{flag} AS active")

    # --- wide table and scores -------------------------------------------------------------------
    def wide(self) -> DataFrame:
        totals = ("count(1) AS n_events", "round(sum(value), 2) AS total_value")
        return self.binned(*totals).selectExpr(
            "user_id", "n_events", "total_value", "bin_start", *TYPES, "labels", *self.FLAGS, f"{scoring.safe_ratio('purchase', 'view', 100.0)} AS ratio")

    def wide_bin_table(self) -> DataFrame:
        rounded = (*TYPES, "ratio")
        wide = self.wide()
        return wide.selectExpr(*[r6(c) if c in rounded else c for c in wide.columns])

    def daily(self, wide: DataFrame) -> DataFrame:
        per_day = group(wide.selectExpr("*", "cast(bin_start AS date) AS day"), ["user_id", "day"],
                        "max(ratio) AS ratio", "min(error) AS error", "max(click) AS click", "min(signup) AS signup",
                        "sum(view) AS view")
        scores = {
            "s_ratio": scoring.band_score("ratio", [("<", 50, 4), ("<", 100, 3), ("<", 200, 2), ("<", 400, 1)], 0),
            "s_error": scoring.band_score("error", [(">=", 300, 4), (">=", 150, 2), (">=", 40, 1)], 0),
            "s_signup": scoring.rule_score(
                [("signup BETWEEN 130 AND 140", 1), ("signup BETWEEN 60 AND 129", 2), ("signup < 60", 4)], 0, present="signup"),
            "s_view": scoring.rule_score(
                [("click >= 300", 4), ("view < 50", 4), ("click >= 100", 2), ("view < 200", 1),
                 ("coalesce(view, click) IS NULL", None)], 0),
        }
        scored = per_day.selectExpr("*", *[f"{sql} AS {n}" for n, sql in scores.items()])
        return scored.selectExpr(
            "*", f"{scoring.score_total(list(scores))} AS total", f"{scoring.missing_pct(list(scores))} AS missing_pct")

    def daily_scores(self) -> DataFrame:
        daily = self.daily(self.wide())
        rounded = ("ratio", "error", "click", "signup", "view")
        return daily.selectExpr(*[r6(c) if c in rounded else c for c in daily.columns])

    def stay_scores(self) -> DataFrame:
        per_user = group(self.wide(), USER, *[f"{f}({c}) AS {c}_{f}" for c in ("error", "click", "signup", "view") for f in ("min", "max")],
                         "sum(purchase) AS purchase")
        scores = {
            "p_error": scoring.two_sided_score(
                "error_min", "error_max",
                [("min", "<", 5, 11), ("max", ">=", 480, 7), ("max", ">=", 300, 4), ("min", "<", 20, 2)], (20, 300)),
            "p_click": scoring.two_sided_score(
                "click_min", "click_max", [("min", "<", 10, 13), ("min", "<", 30, 5), ("max", ">=", 400, 2)], (30, 400)),
            "p_signup": scoring.band_score("signup_max", [("<", 100, 0), ("<", 300, 4), (">=", 300, 9)]),
            "p_view": scoring.band_score("view_min", [("<", 3, None), ("<", 6, 26), ("<", 20, 13), (">=", 20, 0)]),
            "p_purchase": scoring.band_score("purchase", [("<", 500, 11), ("<", 1000, 4), (">=", 1000, 0)]),
        }
        scored = per_user.selectExpr("user_id", *[f"{sql} AS {n}" for n, sql in scores.items()])
        return scored.selectExpr(
            "*", f"{scoring.score_total(list(scores))} AS total", f"{scoring.missing_pct(list(scores))} AS missing_pct")

    def logistic_risk(self) -> DataFrame:
        return self.stay_scores().selectExpr("user_id", "total", r6(scoring.logistic_risk("total"), "risk"))

    def date_key_join(self) -> DataFrame:
        wide = materialize(self.wide(), "wide")
        bins = wide.selectExpr("user_id", "bin_start", "any_error", "cast(bin_start AS date) AS day")
        return bins.join(self.daily(wide).select("user_id", "day", "total", "missing_pct"), ["user_id", "day"])

    def sink_refresh(self) -> DataFrame:
        """All stays written by year and a day late, then refreshed from the table itself: only the refresh is left."""
        path = f"{shared_folder(self.table.spark)}/tidespan/sink-{uuid.uuid4().hex}"
        bounds = ("stay_start", "stay_end")
        late = self.stays().selectExpr("user_id", *[f"{c} + INTERVAL '1' DAY AS {c}" for c in bounds], "year(stay_start) AS year")
        written = write_snapshot(late, path, ["year"])
        return write_snapshot(written.selectExpr("user_id", *[f"{c} - INTERVAL '1' DAY AS {c}" for c in bounds]), path, retain=0)

    def final_semi_filter(self) -> DataFrame:
        rows = materialize(self.binned().selectExpr("user_id", "bin_start", "overlap", r6("signup")), "binned")
        return keep_groups(rows, "user_id", "_flag > 0 AND _seen IS NOT NULL AND _seen > 150",
                           ["max(overlap) AS _flag", "max(signup) AS _seen"], **self.salts)


# queries whose ordered or salted operators treat heavy keys apart; also run with nearly every key heavy
HEAVY = ("asof_fallback", "carry_previous", "state_episodes", "episode_features", "episode_bin_overlap", "interval_overlap_flag", "final_semi_filter",
         "code_book_flags", "full_outer_grid")
HEAVY_ROWS = 20

QUERIES = (
    "code_prefilter_scan", "code_prefilter_clustered", "dim_label_filter", "category_map", "text_flag_by_subject", "stay_outcomes",
    "cohort_first_stay", "order_ranks", "window_avg_ratio", "subject_left_joins", "code_flags", "code_book_flags", "weighted_index",
    "union_pivot_rates", "sum_by_time", "exact_totals", "exact_bin_avg", "guarded_pivot", "asof_fallback", "carry_previous",
    "full_outer_distinct", "full_outer_grid", "group_by_measure", "priority_row_number", "first_service", "distinct_on_first",
    "text_classifier", "text_max_label", "time_spine", "bin_avg", "bin_any_flag", "bin_distinct_list",
    "interval_overlap_flag", "interval_overlap_pairs", "lookback_flags", "lookback_still_active", "flag_union_join", "state_episodes",
    "episode_features", "episode_bin_overlap", "rule_cascade_flag", "wide_bin_table", "daily_scores",
    "stay_scores", "logistic_risk", "date_key_join", "final_semi_filter", "sink_refresh",
)
