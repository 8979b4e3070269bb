"""SQL for the queries in ``tidespan.plans.generic``."""

from __future__ import annotations

from tidespan.oracle.assemble import assemble

TYPES = ("click", "error", "purchase", "signup", "view")
LOOKBACK = ("error", "purchase", "signup")


def _means(rounded: bool) -> str:
    wrap = "round({}, 6)" if rounded else "{}"
    return ", ".join(
        wrap.format(f"avg(CASE WHEN e.event_type = '{t}' THEN e.value END)") + f" AS {t}" for t in TYPES
    )


def _lookback(extra: str) -> str:
    flags = ", ".join(f"max(CASE WHEN e.event_type = '{t}' THEN 1 ELSE 0 END) AS {t}_24h" for t in LOOKBACK)
    return f"""SELECT s.user_id, s.bin_start, {flags}
        FROM spine s LEFT JOIN spans e ON e.user_id = s.user_id AND e.th BETWEEN s.stay_start AND s.stay_end
         AND CAST(e.th AS DATE) >= CAST(s.bin_start AS DATE) - 1 AND e.th < s.bin_start {extra}
        GROUP BY ALL"""


def _exact(total: str) -> str:
    """The double next to a whole number of 2^-60ths: 53 bits are kept, the rest rounds half to even."""
    low = f"greatest(0, CAST(floor(log2(greatest(abs({total}), 1)::DOUBLE)) AS INTEGER) - 52)"
    unit = f"(1::HUGEINT << {low})"
    kept, rest = f"(abs({total}) // {unit})", f"(abs({total}) % {unit})"
    up = f"CASE WHEN {rest} * 2 > {unit} OR ({rest} * 2 = {unit} AND {kept} % 2 = 1) THEN 1 ELSE 0 END"
    return f"sign({total}) * ({kept} + {up})::DOUBLE * pow(2, {low} - 60)"


#: Values are multiples of 2^-60 (0.01 and more), so whole numbers add up without error.
EXACT_SUM = "sum(CAST(value * pow(2, 60) AS HUGEINT))"

CTES = {
    "ev": "SELECT *, date_trunc('hour', ts) AS th FROM events",
    "stays": "SELECT user_id, min(th) AS stay_start, max(th) - INTERVAL 37 HOUR AS stay_end FROM ev GROUP BY user_id",
    "spine": """SELECT user_id, stay_start, stay_end,
        unnest(generate_series(stay_start, stay_end, INTERVAL 4 HOUR)) AS bin_start FROM stays""",
    "inbin": """SELECT s.user_id, s.bin_start, e.event_type, e.value
        FROM spine s LEFT JOIN ev e ON e.user_id = s.user_id AND e.th BETWEEN s.stay_start AND s.stay_end
         AND e.th BETWEEN s.bin_start AND s.bin_start + INTERVAL 4 HOUR""",
    "means": f"SELECT e.user_id, e.bin_start, {_means(False)} FROM inbin e GROUP BY ALL",
    "any_error": """SELECT user_id, bin_start, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS any_error
        FROM inbin GROUP BY ALL""",
    "label_list": """SELECT user_id, bin_start,
        string_agg(DISTINCT CASE WHEN event_type IN ('error', 'signup', 'purchase') THEN event_type END, ', '
                   ORDER BY CASE WHEN event_type IN ('error', 'signup', 'purchase') THEN event_type END) AS labels
        FROM inbin GROUP BY ALL""",
    "spans": """SELECT event_id, user_id, event_type, th,
        CASE WHEN event_id % 10 <> 0 THEN th + INTERVAL 1 HOUR * (CAST(floor(value) AS BIGINT) % 30) END AS stop FROM ev""",
    "overlap_flags": """SELECT s.user_id, s.bin_start, max(CASE WHEN e.th IS NOT NULL THEN 1 ELSE 0 END) AS overlap
        FROM spine s LEFT JOIN spans e ON e.user_id = s.user_id AND e.event_type = 'purchase'
         AND e.th <= s.bin_start + INTERVAL 4 HOUR AND e.stop >= s.bin_start GROUP BY ALL""",
    "lookbacks": _lookback(""),
    "active_lookbacks": _lookback("AND coalesce(e.stop, e.th + INTERVAL 1 HOUR) >= s.bin_start"),
    "all_flags": """SELECT a.*, o.overlap, l.error_24h, l.purchase_24h, l.signup_24h, t.labels
        FROM any_error a JOIN overlap_flags o USING (user_id, bin_start) JOIN lookbacks l USING (user_id, bin_start)
        JOIN label_list t USING (user_id, bin_start)""",
    "marked": """SELECT user_id, ts, event_type, lead(ts) OVER w AS next_ts,
        CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS fresh
        FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_type)""",
    "runs": "SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS run FROM marked",
    "all_episodes": """SELECT user_id, event_type, min(ts) AS starttime, max(coalesce(next_ts, ts)) AS endtime
        FROM runs GROUP BY user_id, event_type, run
        HAVING min(ts) <> max(ts) AND epoch(max(coalesce(next_ts, ts)) - min(ts)) >= 3600""",
    "episodes": """SELECT e.user_id, e.starttime, e.endtime, s.stay_start, s.stay_end,
        round(epoch(endtime - starttime) / 3600) AS ventduration,
        row_number() OVER w AS num_event,
        max(endtime) OVER (PARTITION BY e.user_id ORDER BY starttime DESC) AS end_mech_vent,
        round(epoch(lead(starttime) OVER w - endtime) / 3600) AS time_no_mech_vent
        FROM all_episodes e JOIN stays s ON s.user_id = e.user_id AND e.starttime BETWEEN s.stay_start AND s.stay_end
        WHERE e.event_type = 'view' WINDOW w AS (PARTITION BY e.user_id ORDER BY starttime)""",
    "episode_bins": """SELECT s.user_id, s.bin_start, e.starttime, e.endtime, e.num_event
        FROM spine s LEFT JOIN episodes e ON e.user_id = s.user_id
         AND e.starttime <= s.bin_start + INTERVAL 239 MINUTE AND e.endtime >= s.bin_start""",
    "wide": """SELECT t.*, f.* EXCLUDE (user_id), m.* EXCLUDE (user_id, bin_start),
        m.purchase / nullif(m.view, 0) * 100 AS ratio
        FROM (SELECT user_id, count(*) AS n_events, round(sum(value), 2) AS total_value FROM ev GROUP BY user_id) t
        RIGHT JOIN all_flags f ON f.user_id = t.user_id JOIN means m ON m.user_id = f.user_id AND m.bin_start = f.bin_start""",
    "per_day": """SELECT user_id, CAST(bin_start AS DATE) AS day, max(ratio) AS ratio, min(error) AS error,
        max(click) AS click, min(signup) AS signup, sum(view) AS view FROM wide GROUP BY ALL""",
    "day_scores": """SELECT *,
        CASE WHEN ratio < 50 THEN 4 WHEN ratio < 100 THEN 3 WHEN ratio < 200 THEN 2 WHEN ratio < 400 THEN 1
             WHEN ratio IS NULL THEN NULL ELSE 0 END AS s_ratio,
        CASE WHEN error >= 300 THEN 4 WHEN error >= 150 THEN 2 WHEN error >= 40 THEN 1 WHEN error IS NULL THEN NULL ELSE 0 END AS s_error,
        CASE WHEN signup >= 130 AND signup <= 140 THEN 1 WHEN signup >= 60 AND signup <= 129 THEN 2 WHEN signup < 60 THEN 4
             WHEN signup IS NULL THEN NULL ELSE 0 END AS s_signup,
        CASE WHEN click >= 300 THEN 4 WHEN view < 50 THEN 4 WHEN click >= 100 THEN 2 WHEN view < 200 THEN 1
             WHEN coalesce(view, click) IS NULL THEN NULL ELSE 0 END AS s_view
        FROM per_day""",
    "daily": """SELECT *,
        coalesce(s_ratio, 0) + coalesce(s_error, 0) + coalesce(s_signup, 0) + coalesce(s_view, 0) AS total,
        CAST((CASE WHEN s_ratio IS NULL THEN 1 ELSE 0 END + CASE WHEN s_error IS NULL THEN 1 ELSE 0 END
        + CASE WHEN s_signup IS NULL THEN 1 ELSE 0 END + CASE WHEN s_view IS NULL THEN 1 ELSE 0 END) * 100 // 4 AS BIGINT) AS missing_pct
        FROM day_scores""",
    "per_user": """SELECT user_id, min(error) AS e0, max(error) AS e1, min(click) AS c0, max(click) AS c1,
        max(signup) AS s1, min(view) AS v0, sum(purchase) AS p FROM wide GROUP BY user_id""",
    "stay_points": """SELECT user_id,
        CASE WHEN e1 IS NULL THEN NULL WHEN e0 < 5 THEN 11 WHEN e1 >= 480 THEN 7 WHEN e1 >= 300 THEN 4 WHEN e0 < 20 THEN 2
             WHEN e0 >= 20 AND e1 < 300 THEN 0 END AS p_error,
        CASE WHEN c1 IS NULL THEN NULL WHEN c0 < 10 THEN 13 WHEN c0 < 30 THEN 5 WHEN c1 >= 400 THEN 2
             WHEN c0 >= 30 AND c1 < 400 THEN 0 END AS p_click,
        CASE WHEN s1 < 100 THEN 0 WHEN s1 < 300 THEN 4 WHEN s1 >= 300 THEN 9 END AS p_signup,
        CASE WHEN v0 < 3 THEN NULL WHEN v0 < 6 THEN 26 WHEN v0 < 20 THEN 13 WHEN v0 >= 20 THEN 0 END AS p_view,
        CASE WHEN p < 500 THEN 11 WHEN p < 1000 THEN 4 WHEN p >= 1000 THEN 0 END AS p_purchase
        FROM per_user""",
    "stay_total": """SELECT *,
        coalesce(p_error, 0) + coalesce(p_click, 0) + coalesce(p_signup, 0) + coalesce(p_view, 0) + coalesce(p_purchase, 0) AS total,
        CAST((CASE WHEN p_error IS NULL THEN 1 ELSE 0 END + CASE WHEN p_click IS NULL THEN 1 ELSE 0 END
        + CASE WHEN p_signup IS NULL THEN 1 ELSE 0 END + CASE WHEN p_view IS NULL THEN 1 ELSE 0 END
        + CASE WHEN p_purchase IS NULL THEN 1 ELSE 0 END) * 100 // 5 AS BIGINT) AS missing_pct
        FROM stay_points""",
    "brand_flags": """SELECT l_orderkey,
        max(CASE WHEN p_brand LIKE 'Brand#1%' THEN 1 ELSE 0 END) AS f_prefix,
        max(CASE WHEN p_brand IN ('Brand#12', 'Brand#23') THEN 1 ELSE 0 END) AS f_list,
        max(CASE WHEN substr(p_brand, 1, 8) BETWEEN 'Brand#13' AND 'Brand#19' THEN 1 ELSE 0 END) AS f_range,
        max(CASE WHEN p_size % 2 = 1 AND substr(p_brand, 1, 7) = 'Brand#2' THEN 1
                 WHEN p_size % 2 = 0 AND p_brand IN ('Brand#3', 'Brand#5') THEN 1 ELSE 0 END) AS f_version,
        max(CASE WHEN p_size % 2 = 0 AND substr(p_brand, 1, 7) BETWEEN 'Brand#3' AND 'Brand#5' THEN 1 ELSE 0 END) AS f_short_range
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey""",
    "scored": """SELECT event_id, user_id, ts, CASE WHEN event_type <> 'click' THEN value END AS score,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM ev""",
}

FINALS = {
    "code_prefilter_scan": """SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events
        WHERE event_type IN ('error', 'view', 'purchase') GROUP BY event_type""",
    "code_prefilter_clustered": f"""WITH t AS (SELECT event_type, {EXACT_SUM}::HUGEINT AS s, count(value) AS n FROM events
        WHERE event_type IN ('error', 'view', 'purchase') GROUP BY event_type) SELECT event_type, {_exact('s')} AS total, {_exact('s')} / n AS mean FROM t""",
    "dim_label_filter": """SELECT p_name, count(*) AS n, round(sum(l_quantity), 2) AS quantity
        FROM lineitem JOIN part ON l_partkey = p_partkey WHERE regexp_matches(lower(p_name), 'widget|ring') GROUP BY p_name""",
    "category_map": """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'postSurgical '
        WHEN o_orderpriority = '5-LOW' THEN 'intensiveCare' END AS category FROM orders""",
    "text_flag_by_subject": """SELECT c_custkey, max(CASE WHEN o_orderkey IS NULL THEN NULL WHEN o_orderpriority LIKE '%URGENT%' THEN 1 ELSE 0 END) AS urgent
        FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""",
    "stay_outcomes": """SELECT o_orderkey, CAST(round(CAST(epoch(l_shipdate - o_orderdate) / 86400 AS DECIMAL(38, 10)), 2) AS DOUBLE) AS los_day,
        CASE WHEN l_shipdate < o_orderdate + INTERVAL 28 DAY THEN 1 ELSE 0 END AS within28,
        CASE WHEN l_shipdate < o_orderdate + INTERVAL 90 DAY THEN 1 ELSE 0 END AS within90,
        round(CAST(round(CAST(l_linenumber + 20 + epoch(o_orderdate - TIMESTAMP '1995-01-01') / 31556908.8::DOUBLE AS DECIMAL(38, 10)), 2) AS DOUBLE)) AS age
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "cohort_first_stay": """SELECT * FROM (SELECT o_custkey, o_orderkey, o_orderdate, l_shipdate,
        dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST) AS hospstay_seq,
        dense_rank() OVER (PARTITION BY o_orderkey ORDER BY l_shipdate NULLS FIRST) AS icustay_seq
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey) WHERE hospstay_seq = 1 AND icustay_seq = 1""",
    "order_ranks": """SELECT o_custkey, o_orderkey, o_orderdate,
        dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST) AS hospstay_seq FROM orders""",
    "sink_refresh": "SELECT * FROM stays",
    "window_avg_ratio": """SELECT o_orderkey AS order_key, round(avg(l_extendedprice), 6) AS weight, round(avg(l_quantity), 6) AS height,
        round(avg(l_extendedprice) / nullif(pow(avg(l_quantity) / 10, 2), 0), 6) AS ratio
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
         AND l_shipdate BETWEEN o_orderdate - INTERVAL 30 DAY AND o_orderdate + INTERVAL 90 DAY GROUP BY o_orderkey""",
    "subject_left_joins": """SELECT c_custkey, n_orders, total, n_name, r_name FROM customer
        LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1) ON o_custkey = c_custkey
        LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""",
    "code_flags": "SELECT * FROM brand_flags",
    "code_book_flags": f"""WITH r AS (SELECT printf('%04X', i * 7919 % 65536) AS low, printf('%04X', least(65535, i * 7919 % 65536 + i % 7)) AS high,
          i % 40 AS flag, CASE WHEN i % 3 = 0 THEN i % 2 END AS version FROM range(5000) t(i)),
        c AS (SELECT DISTINCT l_partkey, printf('%08X', CAST(l_partkey::HUGEINT * 2654435761 % 4294967296 AS BIGINT)) AS code FROM lineitem),
        h AS (SELECT DISTINCT l_partkey, flag FROM c JOIN r ON substr(code, 1, 4) BETWEEN low AND high AND (version IS NULL OR version = l_partkey % 2))
        SELECT l_orderkey, {', '.join(f"max(CASE WHEN flag = {f} THEN 1 ELSE 0 END) AS b{f}" for f in range(40))}
        FROM lineitem LEFT JOIN h USING (l_partkey) GROUP BY l_orderkey""",
    "weighted_index": """SELECT l_orderkey, f_prefix + greatest(f_list, 3 * f_range) + greatest(2 * f_version, f_short_range) AS index
        FROM brand_flags""",
    "text_classifier": """SELECT p_partkey, CASE WHEN p_name IS NULL THEN NULL WHEN p_name ILIKE '%bolt%' OR p_name ILIKE '%ring%' THEN 'fastener'
        WHEN (p_name ILIKE '%small%' AND p_name ILIKE '%gizmo%') OR p_name ILIKE '%small gear%' THEN 'small tool'
        WHEN p_name ILIKE '%gear%' OR p_name ILIKE '%plate%' THEN 'plain' ELSE 'other' END AS class FROM part""",
    "text_max_label": """SELECT l_orderkey, p_type, max(p_name) AS label FROM lineitem JOIN part ON l_partkey = p_partkey
        GROUP BY l_orderkey, p_type""",
    "union_pivot_rates": "WITH u AS ("
        + " UNION ALL ".join(
            "SELECT user_id, th, " + ", ".join(
                (("CASE WHEN value < 1 THEN value * 60 ELSE value END" if t == "view" else "value") if c == t else "CAST(NULL AS DOUBLE)")
                + f" AS rate_{c}" for c in TYPES)
            + f" FROM ev WHERE event_type = '{t}'" for t in TYPES)
        + "), m AS (SELECT user_id, th, " + ", ".join(f"max(rate_{t}) AS rate_{t}" for t in TYPES) + """ FROM u GROUP BY ALL)
        SELECT *, round(coalesce(rate_error, 0) + coalesce(rate_view * 0.01::DOUBLE, 0) + coalesce(rate_click * 8.33::DOUBLE, 0)
        + coalesce(rate_purchase * 0.01::DOUBLE, 0) + coalesce(rate_signup, 0), 6) AS rate_total FROM m""",
    "exact_totals": f"""WITH t AS (SELECT event_type, {EXACT_SUM}::HUGEINT AS s, count(value) AS n FROM events GROUP BY event_type)
        SELECT event_type, {_exact('s')} AS total, {_exact('s')} / n AS mean FROM t""",
    "exact_bin_avg": f"""WITH t AS (SELECT user_id, bin_start, event_type, {EXACT_SUM}::HUGEINT AS s, count(value) AS n FROM inbin GROUP BY ALL)
        SELECT user_id, bin_start, {', '.join(f"max(CASE WHEN event_type = '{t}' THEN {_exact('s')} / n END) AS {t}" for t in TYPES)}
        FROM t GROUP BY ALL""",
    "sum_by_time": """SELECT user_id, th, round(sum(value), 2) AS output FROM ev WHERE event_type IN ('click', 'view', 'signup') GROUP BY ALL""",
    "guarded_pivot": """SELECT user_id, th, round(avg(CASE WHEN event_type = 'error' AND value > 0 AND value < 100 THEN value END), 6) AS error,
        round(avg(CASE WHEN event_type IN ('view', 'signup') AND value > 50 AND value < 400 THEN value END), 6) AS seen,
        round(avg(CASE WHEN event_type = 'click' AND value > 70 AND value < 120 THEN (value - 32) / 1.8::DOUBLE
                       WHEN event_type = 'purchase' AND value > 10 AND value <= 50 THEN value END), 6) AS temp
        FROM ev GROUP BY ALL""",
    "group_by_measure": """SELECT user_id, CAST(ts AS DATE) AS day, event_type, CAST(floor(value / 50) AS BIGINT) AS band,
        round(avg(value), 6) AS mean, count(*) AS n FROM ev GROUP BY ALL""",
    "asof_fallback": """WITH v AS (SELECT user_id, ts, avg(value) AS x FROM ev WHERE event_type = 'view' GROUP BY ALL),
        c AS (SELECT user_id, ts, avg(value) AS x FROM ev WHERE event_type = 'click' GROUP BY ALL),
        j AS (SELECT e.event_id, e.user_id, e.ts, e.value,
               CASE WHEN v.ts >= e.ts - INTERVAL 48 HOUR THEN v.x END AS view, CASE WHEN c.ts >= e.ts - INTERVAL 48 HOUR THEN c.x END AS click
              FROM (SELECT * FROM ev WHERE event_type = 'error') e
              ASOF LEFT JOIN v ON v.user_id = e.user_id AND v.ts <= e.ts ASOF LEFT JOIN c ON c.user_id = e.user_id AND c.ts <= e.ts)
        SELECT event_id, user_id, ts, view, click, coalesce(CASE WHEN value < 100 THEN value END, view, click) AS filled FROM j""",
    "carry_previous": """SELECT a.event_id, a.user_id, a.ts, a.score, b.score AS prev_score, coalesce(a.score, b.score, 6.0::DOUBLE) AS filled
        FROM scored a LEFT JOIN scored b ON b.user_id = a.user_id AND b.rn = a.rn - 1 AND b.ts > a.ts - INTERVAL 6 HOUR""",
    "full_outer_distinct": """WITH c AS (SELECT user_id, th, CAST(floor(value / 100) AS BIGINT) AS click FROM ev WHERE event_type = 'click'),
        v AS (SELECT user_id, th, max(value) AS view FROM ev WHERE event_type = 'view' GROUP BY ALL)
        SELECT c.user_id, c.th, c.click, v.view FROM c LEFT JOIN v ON v.user_id = c.user_id AND v.th = c.th
        UNION SELECT v.user_id, v.th, NULL, v.view FROM v ANTI JOIN c ON v.user_id = c.user_id AND v.th = c.th""",
    "full_outer_grid": """WITH s AS (SELECT DISTINCT user_id, th AS signup_time, CAST(floor(value / 100) AS BIGINT) AS signup FROM ev WHERE event_type = 'signup'),
        e AS (SELECT DISTINCT user_id, th AS error_time, CAST(floor(value / 100) AS BIGINT) AS error FROM ev WHERE event_type = 'error')
        SELECT coalesce(s.user_id, e.user_id) AS user_id, signup_time, signup, error_time, error FROM s FULL JOIN e ON s.user_id = e.user_id""",
    "priority_row_number": """SELECT event_id, user_id, day, event_type, value FROM (SELECT *, CAST(ts AS DATE) AS day,
        row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_type DESC, value, event_id DESC) AS rn FROM ev) WHERE rn = 1""",
    "first_service": """SELECT conv_id, turn, role FROM (SELECT conv_id, turn, role,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role) AS rn FROM conversations) WHERE rn = 1""",
    "distinct_on_first": """SELECT DISTINCT ON (user_id) user_id, ts, event_id, value FROM ev WHERE value > 150 ORDER BY user_id, ts, event_id""",
    "time_spine": """SELECT user_id, CAST(epoch(bin_start - stay_start) / 14400 AS BIGINT) AS bin_index, bin_start FROM spine""",
    "bin_avg": f"SELECT e.user_id, e.bin_start, {_means(True)} FROM inbin e GROUP BY ALL",
    "bin_any_flag": "SELECT * FROM any_error",
    "bin_distinct_list": "SELECT * FROM label_list",
    "interval_overlap_flag": "SELECT * FROM overlap_flags",
    "interval_overlap_pairs": """SELECT a.user_id, a.event_id AS purchase_id, b.event_id AS error_id, greatest(a.th, b.th) AS starttime, least(a.stop, b.stop) AS stoptime
        FROM spans a JOIN spans b ON a.user_id = b.user_id AND a.th <= b.stop AND b.th <= a.stop
        WHERE a.event_type = 'purchase' AND b.event_type = 'error' AND a.th <= a.stop AND b.th <= b.stop""",
    "lookback_flags": "SELECT * FROM lookbacks",
    "lookback_still_active": "SELECT * FROM active_lookbacks",
    "flag_union_join": "SELECT * FROM all_flags",
    "state_episodes": "SELECT * FROM all_episodes",
    "episode_features": "SELECT * FROM episodes",
    "episode_bin_overlap": "SELECT * FROM episode_bins",
    "rule_cascade_flag": """SELECT b.user_id, b.bin_start, b.starttime,
        CASE WHEN b.starttime IS NULL THEN 0
             WHEN m.error IS NOT NULL AND m.view IS NOT NULL AND m.click IS NOT NULL THEN 1
             WHEN b.num_event = 1 THEN 1
             WHEN coalesce(m.error, m.click) IS NOT NULL AND m.view IS NOT NULL THEN 1 ELSE 0 END AS active
        FROM episode_bins b JOIN means m USING (user_id, bin_start)""",
    "wide_bin_table": "SELECT * REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in (*TYPES, "ratio")) + ") FROM wide",
    "daily_scores": "SELECT * REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in ("ratio", "error", "click", "signup", "view")) + ") FROM daily",
    "stay_scores": "SELECT * FROM stay_total",
    "logistic_risk": """SELECT user_id, total, round(1 / (1 + exp(-(-7.7631::DOUBLE + 0.0737::DOUBLE * total + 0.9971::DOUBLE * ln(total + 1)))), 6) AS risk
        FROM stay_total""",
    "date_key_join": """SELECT f.user_id, f.bin_start, f.any_error, d.day, d.total, d.missing_pct
        FROM all_flags f JOIN daily d ON d.user_id = f.user_id AND CAST(f.bin_start AS DATE) = d.day""",
    "final_semi_filter": """WITH x AS (SELECT f.user_id, f.bin_start, f.overlap, round(m.signup, 6) AS signup FROM all_flags f JOIN means m USING (user_id, bin_start))
        SELECT * FROM x WHERE user_id IN (SELECT user_id FROM x GROUP BY user_id HAVING max(overlap) > 0 AND max(signup) IS NOT NULL AND max(signup) > 150)""",
}


def _nested(sql: str) -> str:
    """Finals may bring their own WITH; put the shared expressions in front."""
    if not sql.startswith("WITH"):
        return assemble(CTES, sql)
    return assemble(CTES, "SELECT * FROM (" + sql + ")")


def oracle() -> dict[str, str]:
    return {name: _nested(sql) for name, sql in FINALS.items()}
