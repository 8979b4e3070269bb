"""Ventilation: status, episodes, settings per bin and the intubation flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidespan.functions.text import first_match, in_list, quote
from tidespan.operators.bins import bin_aggregate, overlapped_bins
from tidespan.operators.episodes import episode_features, state_episodes
from tidespan.operators.ranking import first_per_key
from tidespan.plans import rules

DEVICE, MODE, HAMILTON = "o2_delivery_device_1", "ventilator_mode", "ventilator_mode_hamilton"
PARAMETERS = ("tidal_volume", "peep", "fio2", "vent_mode", "vent_type")
EPISODE_COLUMNS = ("is_tracheo", "tracheo_ts", "end_mech_vent", "time_no_mech_vent", "next_intubation_time")


def status_expression() -> str:
    """Ventilation status of a settings row, most invasive first; NULL when nothing is recognised."""
    tube = in_list(DEVICE, rules.TUBES)
    invasive = " OR ".join([
        tube,
        in_list(MODE, rules.INVASIVE_MODES),
        f"({in_list(MODE, rules.TUBE_ONLY_MODES)} AND {tube})",
        in_list(HAMILTON, rules.HAMILTON_INVASIVE_MODES),
        f"({HAMILTON} = {quote(rules.HAMILTON_DUAL_MODE)} AND {tube})",
    ])
    return first_match([
        (invasive, rules.INVASIVE),
        (f"{in_list(DEVICE, rules.NONINVASIVE_DEVICES)} OR {in_list(HAMILTON, rules.HAMILTON_NONINVASIVE_MODES)}", "NonInvasiveVent"),
        (in_list(DEVICE, rules.HIGH_FLOW_DEVICES), "HFNC"),
        (in_list(DEVICE, rules.OXYGEN_DEVICES), "SupplementalOxygen"),
        (f"{DEVICE} = 'None'", "None"),
    ])


def ventilation_episodes(stays: DataFrame, ventilator_setting: DataFrame, oxygen_delivery: DataFrame,
                         max_gap_hours: float | None = None, heavy: bool = True) -> DataFrame:
    """Invasive ventilation episodes of at least an hour that start inside the stay. ``heavy``: as in ``time_chunks``."""
    settings = ventilator_setting.select("stay_id", "charttime", MODE, HAMILTON)
    observed = settings.join(oxygen_delivery, ["stay_id", "charttime"], "left").selectExpr(
        "stay_id", "charttime", f"{status_expression()} AS status",
        f"CASE WHEN {in_list(DEVICE, rules.TRACHEOSTOMY_DEVICES)} THEN charttime END AS tracheo_ts",
    )
    episodes = state_episodes(observed, ["stay_id"], "charttime", "status", keep=[rules.INVASIVE], earliest=["tracheo_ts"],
                              max_gap_hours=max_gap_hours, count_on=ventilator_setting, crowded=False, heavy=heavy)  # a status or two a stay and time
    inside = episodes.join(stays.select("stay_id", "icu_intime", "icu_outtime"), "stay_id").filter(
        "starttime BETWEEN icu_intime AND icu_outtime"
    )
    return episode_features(inside, ["stay_id"], marker="tracheo_ts").select(
        "stay_id", "icu_intime", "icu_outtime", "starttime", "endtime", "tracheo_ts", "is_tracheo", "ventduration",
        "num_event", "end_mech_vent", "time_no_mech_vent",
    )


def ventilator_bins(ventilator_setting: DataFrame, stays: DataFrame) -> DataFrame:
    """Mean settings and last mode and type by name, per bin of the given stays."""
    volume = "coalesce(tidal_volume_observed, tidal_volume_set, tidal_volume_spontaneous)"
    settings = ventilator_setting.selectExpr(
        "stay_id", "charttime", f"CASE WHEN {volume} < {rules.MAX_TIDAL_VOLUME} THEN {volume} END AS tidal_volume",
        "peep", "fio2", f"coalesce({MODE}, {HAMILTON}) AS vent_mode", "ventilator_type AS vent_type",
    )
    aggs = [f"{'max' if c in ('vent_mode', 'vent_type') else 'avg'}({c}) AS {c}" for c in PARAMETERS]
    windows = stays.select("stay_id", "icu_intime", "icu_outtime")
    return bin_aggregate(settings, windows, ["stay_id"], "charttime", "icu_intime", "icu_outtime", aggs)


def ventilated(frame: DataFrame, episodes: DataFrame) -> DataFrame:
    """Rows of stays with at least one ventilation episode."""
    return frame.join(episodes.select("stay_id").distinct(), "stay_id", "left_semi")


def settings_outside(ventilator_setting: DataFrame, ventilated_stays: DataFrame) -> DataFrame:
    """One row without bin per ventilated stay that has settings outside its window."""
    windows = ventilated_stays.select("stay_id", "icu_intime", "icu_outtime")
    # first and last setting decide, so the settings are reduced before the join
    ends = ventilator_setting.groupBy("subject_id", "stay_id").agg(
        F.expr("min(charttime) AS first"), F.expr("max(charttime) AS last"), F.expr("bool_or(charttime IS NULL) AS untimed"))
    return ends.join(windows, "stay_id").filter("untimed OR first < icu_intime OR last > icu_outtime").select("subject_id", "stay_id")


def vent_param(spine: DataFrame, settings: DataFrame, outside: DataFrame | None = None) -> DataFrame:
    """Every bin of the ventilated stays with its settings, plus the rows without bin."""
    rows = spine.select("subject_id", "stay_id", "bin_index", "icu_day_start").join(settings, ["stay_id", "bin_index"], "left")
    if outside is not None:
        rows = rows.unionByName(outside, allowMissingColumns=True)
    return rows.select("subject_id", "stay_id", "icu_day_start", *PARAMETERS, "bin_index")


def intubation_expression() -> str:
    """1 when an episode overlaps the bin and settings, mode or tracheostomy confirm the tube."""
    complete = "peep IS NOT NULL AND fio2 IS NOT NULL AND tidal_volume IS NOT NULL"
    other = f"(vent_type <> 'Hamilton' OR vent_type IS NULL) AND {in_list('vent_mode', rules.INTUBATED_MODES)}"
    hamilton = f"vent_type = 'Hamilton' AND {in_list('vent_mode', rules.INTUBATED_HAMILTON_MODES)}"
    return f"""CASE
        WHEN intubation_time IS NULL THEN 0
        WHEN {complete} AND (({other}) OR ({hamilton})) THEN 1
        WHEN is_tracheo = 0 AND (NOT ({complete}) OR vent_mode IS NULL) THEN 1
        WHEN is_tracheo = 1 AND coalesce(peep, tidal_volume) IS NOT NULL AND fio2 IS NOT NULL THEN 1
        ELSE 0 END"""


def intubation(params: DataFrame, episodes: DataFrame, stays: DataFrame, one_row_per_bin: bool = False,
               heavy: bool = True) -> DataFrame:
    """Bins with the episodes that overlap them; a bin with several episodes has several rows.

    ``one_row_per_bin`` keeps the earliest episode only. ``heavy``: as in ``salted_join``.
    """
    spans = episodes.selectExpr(
        "stay_id", "starttime AS intubation_time", "coalesce(endtime, starttime + INTERVAL '12' HOUR) AS extubation_time",
        "is_tracheo", "tracheo_ts", "end_mech_vent", "time_no_mech_vent",
        "lead(starttime) OVER (PARTITION BY stay_id ORDER BY starttime) AS next_intubation_time",
    )
    hits = overlapped_bins(spans, stays.select("stay_id", "icu_intime", "icu_outtime"), ["stay_id"], "intubation_time",
                           "extubation_time", "icu_intime", "icu_outtime", reach_minutes=rules.EPISODE_REACH_MINUTES,
                           apart=["stay_id", "intubation_time", "extubation_time"], heavy=heavy)
    if one_row_per_bin:
        hits = first_per_key(hits, ["stay_id", "bin_index"], "intubation_time ASC NULLS LAST")
    matched = hits.select("stay_id", "bin_index", "intubation_time", "extubation_time", *EPISODE_COLUMNS)
    return params.join(matched, ["stay_id", "bin_index"], "left").selectExpr(
        "subject_id", "stay_id", "icu_day_start", *PARAMETERS, f"{intubation_expression()} AS is_intubated",
        "intubation_time", "extubation_time", *EPISODE_COLUMNS,
    )
