"""Measurements: infusion rates, urine, laboratory and vital signs, per time and per bin."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidespan.functions.rounding import round_half_up
from tidespan.functions.text import in_list, quote
from tidespan.operators.asof import asof_backward, carry_previous
from tidespan.operators.bins import bin_aggregate
from tidespan.operators.pivot import all_codes, guarded_pivot, guarded_value
from tidespan.operators.ranking import first_per_key
from tidespan.operators.skew import CHUNK
from tidespan.plans import rules

STAY_KEYS = ["subject_id", "hadm_id", "stay_id"]
LAB_COLUMNS = tuple(m.name for m in rules.LABS)
RATE_COLUMNS = tuple(f"rate_{drug}" for drug in rules.VASOPRESSORS)
VITAL_COLUMNS = tuple(dict.fromkeys(m.name for m in rules.VITALS))


def vasopressors(inputevents: DataFrame) -> DataFrame:
    """Rates of the five drugs per stay and start time: one scan, one conditional aggregate."""
    drugs = rules.VASOPRESSORS
    rate = f"""CASE
        WHEN itemid = {drugs['norepinephrine']} AND rateuom = 'mg/kg/min' AND (patientweight <> 1 OR patientweight IS NULL) THEN rate * 1000D
        WHEN itemid = {drugs['vasopressin']} AND rateuom = 'units/min' THEN rate * 60D
        ELSE rate END"""
    rates = (
        inputevents.filter(in_list("itemid", tuple(drugs.values())))
        .selectExpr("stay_id", "starttime", "itemid", f"{rate} AS rate")
        .groupBy("stay_id", "starttime")
        .agg(*[F.expr(f"max(CASE WHEN itemid = {item} THEN rate END) AS rate_{drug}") for drug, item in drugs.items()])
    )
    # norepinephrine equivalents
    total = (
        "coalesce(rate_norepinephrine, 0D) + coalesce(rate_dopamine / 100D, 0D) + coalesce(rate_vasopressin * 8.33D, 0D)"
        " + coalesce(rate_dobutamine / 100D, 0D) + coalesce(rate_epinephrine, 0D)"
    )
    return rates.selectExpr("*", f"{total} AS vaso_total")


def urine_output(outputevents: DataFrame) -> DataFrame:
    """Urine volume per stay and time."""
    return (
        outputevents.filter(in_list("itemid", rules.URINE_ITEMS))
        .groupBy(*STAY_KEYS, "charttime").agg(F.expr("sum(value) AS urineoutput"))
    )


def counted_labs(labevents: DataFrame) -> DataFrame:
    """The rows whose patients ``lab_values`` counts to find heavy ones."""
    return labevents.filter(in_list("itemid", all_codes((*rules.LABS, rules.HEMATOCRIT))))


def lab_values(labevents: DataFrame, chartevents: DataFrame, count_on: DataFrame | None = None, heavy: bool = True) -> DataFrame:
    """Laboratory values per patient and time, blood gases completed from the bedside chart.

    A missing PaO2 or PaCO2 takes the latest charted value of the two hours before. When a patient has rows of
    several admissions at one time, those of the lowest admission id stand. ``count_on``: the table that heavy keys
    are counted on, if ``labevents`` is not a plain scan. ``heavy``: as in ``time_chunks``.
    """
    measures = (*rules.LABS, rules.HEMATOCRIT)
    wide = guarded_pivot(labevents, ["subject_id", "hadm_id", "charttime"], measures, "itemid", "valuenum")
    rows = first_per_key(wide, ["subject_id", "charttime"], "hadm_id ASC NULLS LAST").drop("hadm_id", rules.HEMATOCRIT.name)

    gases = {"po2": rules.CHARTED_PO2, "pco2": rules.CHARTED_PCO2}
    # one scan for both; a time without a gas has no row of it
    charted = chartevents.filter(in_list("itemid", tuple(gases.values()))).groupBy("subject_id", "charttime").agg(*[
        F.expr(f"CASE WHEN count_if(itemid = {item}) > 0 THEN named_struct('v', avg(CASE WHEN itemid = {item} THEN valuenum END)) END AS {name}")
        for name, item in gases.items()])
    found = asof_backward(
        rows, charted, ["subject_id"], "charttime", rules.BLOOD_GAS_TOLERANCE_HOURS,
        count_on=counted_labs(labevents if count_on is None else count_on), apart=["subject_id", "charttime"],
        crowded=False, heavy=heavy,  # one row a patient and time
    )
    fallback = {"pao2": "coalesce(pao2, po2) AS pao2", "paco2": "coalesce(paco2, pco2) AS paco2"}
    return found.selectExpr("subject_id", "charttime", *[fallback.get(c, c) for c in LAB_COLUMNS])


def counted_vitals(chartevents: DataFrame) -> DataFrame:
    """The rows whose stays ``vital_signs`` counts to find heavy ones."""
    return chartevents.filter(in_list("itemid", [*all_codes(rules.VITALS), *rules.GCS_ITEMS.values()]))


def vital_signs(chartevents: DataFrame, count_on: DataFrame | None = None, with_stay: bool = False, heavy: bool = True) -> DataFrame:
    """Vital signs and coma score per stay and time.

    Vital signs and coma-scale components come from one scan and one exchange. Equal values at one time count
    once. A coma score fills missing components from the row before if that is less than six hours old. If a stay
    has several coma rows at one time (of several admissions), the one with the most components stands, then the
    one without tube, then the lowest score, then the lowest ids; all vital signs of that stay and time get it.
    Rows without stay or time match no other row: their vital signs and their score stay apart. ``with_stay``: every row
    has a stay, so the rows of a stay and time are compared where the coma score was carried. ``heavy``: as in ``time_chunks``.
    """
    keys = [*STAY_KEYS, "charttime"]
    gcs = rules.GCS_ITEMS
    vital_codes = in_list("itemid", all_codes(rules.VITALS))
    names = {m.name: in_list("itemid", [c for v in rules.VITALS if v.name == m.name for c in v.codes]) for m in rules.VITALS}
    names |= {name: f"itemid = {item}" for name, item in gcs.items()}
    measure = "CASE " + " ".join(f"WHEN {cond} THEN '{name}'" for name, cond in names.items()) + " END"
    value = guarded_value(rules.VITALS, "itemid", "valuenum")
    rows = counted_vitals(chartevents).selectExpr(
        *keys, f"{measure} AS measure",
        f"CASE WHEN {in_list('itemid', tuple(gcs.values()))} THEN valuenum ELSE {value} END AS x",
        f"{vital_codes} AS vital", f"coalesce(itemid = {gcs['verbal']} AND value = {quote(rules.TUBE_ANSWER)}, false) AS tube",
    )
    # copies go within their stay and time, so the rows are dealt once for this and the pivot, or not at all if a join has dealt them
    own = ("measure", "x", "vital", "tube")  # ``vital`` is never NULL, so the first row equals none before it
    order = f"OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join(own)})"
    beside = rows.selectExpr("*", *[f"lag({c}) {order} AS _{c}" for c in own])
    apart = beside.filter(f"NOT ({' AND '.join(f'{c} <=> _{c}' for c in own)})").drop(*[f"_{c}" for c in own])
    wide = apart.groupBy(*keys).agg(
        *[F.expr(f"{'max' if n == 'tempc' else 'avg'}(CASE WHEN measure = '{n}' THEN x END) AS {n}") for n in VITAL_COLUMNS],
        *[F.expr(f"max(CASE WHEN measure = '{n}' THEN x END) AS {n}") for n in gcs],
        F.expr("max(NOT vital) AS scored"), F.expr("max(vital) AS charted"), F.expr("max(tube) AS tube"),
    )
    carried = carry_previous(wide, ["stay_id"], "charttime", list(gcs), rules.GCS_LIMIT_HOURS, tie=["hadm_id", "subject_id"],
                             only="scored", count_on=counted_vitals(chartevents if count_on is None else count_on), apart=keys,
                             crowded=False, pieces=with_stay, heavy=heavy)  # one row a stay and time
    own = " + ".join(f"coalesce({n}, {normal})" for n, normal in rules.GCS_NORMAL.items())
    filled = " + ".join(f"coalesce({n}, prev_{n}, {normal})" for n, normal in rules.GCS_NORMAL.items())
    score = f"CASE WHEN coalesce(verbal, prev_verbal) = 0 THEN 15 WHEN prev_verbal = 0 THEN {own} ELSE {filled} END"
    missing = " + ".join(f"cast(coalesce({n}, prev_{n}) IS NULL AS int)" for n in gcs)
    place = f"CASE WHEN scored THEN struct({missing} AS missing, tube, cast({score} AS double) AS gcs, hadm_id, subject_id) END"
    # rows of one stay and time are in one piece of it
    together = f"OVER (PARTITION BY {', '.join(['stay_id', *(CHUNK if with_stay else ()), 'charttime'])})"
    ranked = carried.selectExpr("*", f"{place} AS _place").selectExpr(
        "*", f"min(_place) {together} AS _best", f"bool_or(charted) {together} AS _any", "stay_id IS NULL OR charttime IS NULL AS _apart")
    parts = "filter(array(CASE WHEN charted THEN 'vital' END, CASE WHEN _place = _best AND (_apart OR NOT _any) THEN 'score' END), p -> p IS NOT NULL)"
    placed = ranked.selectExpr("*", f"explode({parts}) AS _part")
    rounded = [f"{round_half_up(n)} AS {n}" if n == "tempc" else f"rint({n}) AS {n}" for n in VITAL_COLUMNS]
    # means of doubles round half to even
    return placed.selectExpr(
        *keys, "CASE WHEN _part = 'score' OR NOT _apart THEN _best.gcs END AS gcs",
        *[f"CASE WHEN _part = 'vital' THEN {n} END AS {n}" for n in VITAL_COLUMNS],
    ).selectExpr(*keys, "gcs", *rounded)


# --- per bin: only bins with data, keyed by (stay_id, bin_index) -----------------------------------
def _binned(events: DataFrame, stays: DataFrame, keys: Sequence[str], time: str, aggs: Sequence[str]) -> DataFrame:
    windows = stays.select(*dict.fromkeys([*keys, "stay_id"]), "icu_intime", "icu_outtime")
    return bin_aggregate(events, windows, keys, time, "icu_intime", "icu_outtime", aggs, stay_keys=["stay_id"])


def lab_bins(labs: DataFrame, stays: DataFrame) -> DataFrame:
    return _binned(labs, stays, ["subject_id"], "charttime", [f"avg({c}) AS {c}" for c in LAB_COLUMNS])


def urine_bins(urine: DataFrame, stays: DataFrame, how: str = "avg") -> DataFrame:
    return _binned(urine, stays, STAY_KEYS, "charttime", [f"{how}(urineoutput) AS uo"])


def vital_bins(vitals: DataFrame, stays: DataFrame) -> DataFrame:
    aggs = ["rint(avg(gcs)) AS gcs"]
    for c in VITAL_COLUMNS:
        aggs.append({"tempc": f"{round_half_up('max(tempc)')} AS tempc", "spo2": "avg(spo2) AS spo2"}.get(c, f"rint(avg({c})) AS {c}"))
    return _binned(vitals, stays, STAY_KEYS, "charttime", aggs)


def vasopressor_bins(rates: DataFrame, stays: DataFrame) -> DataFrame:
    return _binned(rates.drop("vaso_total"), stays, ["stay_id"], "starttime", [f"avg({c}) AS {c}" for c in RATE_COLUMNS])
