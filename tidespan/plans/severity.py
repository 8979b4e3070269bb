"""Severity scores: one per stay, one per stay and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidespan.functions.scoring import band_score, logistic_risk, missing_pct, rule_score, score_total, two_sided_score
from tidespan.functions.text import first_match, matches_any, quote
from tidespan.operators.bins import events_in_window
from tidespan.operators.codes import code_flags
from tidespan.operators.ranking import first_per_key
from tidespan.plans import rules

STAY_KEYS = ["subject_id", "hadm_id", "stay_id"]
SAPS_SCORES = ("age_score", "hr_score", "sysbp_score", "temp_score", "pao2fio2_score", "uo_score", "bun_score", "wbc_score",
               "potassium_score", "sodium_score", "bicarbonate_score", "bilirubin_score", "gcs_score", "comorbidity_score",
               "admissiontype_score")
SOFA_SCORES = ("respiration", "cns", "cardiovascular", "liver", "coagulation", "renal")


def saps_components() -> dict[str, str]:
    return {
        "age_score": band_score("age", rules.AGE_POINTS),
        "hr_score": two_sided_score("heartrate_min", "heartrate_max", rules.HEARTRATE_POINTS, rules.HEARTRATE_NORMAL),
        "sysbp_score": two_sided_score("sysbp_min", "sysbp_max", rules.SYSBP_POINTS, rules.SYSBP_NORMAL),
        "temp_score": rule_score([(f"tempc_max >= {rules.FEVER_LIMIT}", 3), (f"tempc_min < {rules.FEVER_LIMIT}", 0)], present="tempc_max"),
        "pao2fio2_score": band_score("pao2fio2_vent_min", rules.OXYGENATION_POINTS),
        "uo_score": band_score("urineoutput", rules.URINE_POINTS),
        "bun_score": band_score("bun_max", rules.BUN_POINTS),
        "wbc_score": two_sided_score("wbc_min", "wbc_max", rules.WBC_POINTS, rules.WBC_NORMAL),
        "potassium_score": two_sided_score("potassium_min", "potassium_max", rules.POTASSIUM_POINTS, rules.POTASSIUM_NORMAL),
        "sodium_score": two_sided_score("sodium_min", "sodium_max", rules.SODIUM_POINTS, rules.SODIUM_NORMAL),
        "bicarbonate_score": band_score("bicarbonate_min", rules.BICARBONATE_POINTS),
        "bilirubin_score": band_score("bilirubin_max", rules.BILIRUBIN_POINTS),
        "gcs_score": band_score("mingcs", rules.COMA_POINTS),
        "comorbidity_score": rule_score([(f"{flag} = 1", points) for flag, points in rules.COMORBIDITY_POINTS], 0),
        "admissiontype_score": rule_score([(f"admissiontype = {quote(kind)}", points) for kind, points in rules.ADMISSION_POINTS]),
    }


def saps(wide: DataFrame, icustays: DataFrame, admissions: DataFrame, services: DataFrame, diagnoses_icd: DataFrame,
         ventilation: DataFrame, chartevents: DataFrame, hours: int | None = None) -> DataFrame:
    """SAPS II per stay of the wide table.

    ``hours=None`` uses every bin of the stay; a number limits the bins to the first hours. The oxygenation
    score counts for patients with invasive ventilation in the stay or CPAP in the first 24 hours.
    """
    rows = wide if hours is None else wide.filter(f"icu_day_start < icu_intime + INTERVAL '{hours}' HOUR")
    ends = [F.expr(f"{f}({c}) AS {c}_{f}") for f in ("min", "max")
            for c in ("heartrate", "sysbp", "tempc", "bun", "wbc", "potassium", "sodium", "bicarbonate", "bilirubin")]
    per_stay = rows.groupBy("subject_id", "stay_id", F.expr("icu_intime AS starttime"), "age").agg(
        *ends, F.expr("min(gcs) AS mingcs"), F.expr("sum(uo) AS urineoutput"), F.expr("min(pao2fio2ratio) AS ratio_min"))
    per_stay = per_stay.selectExpr("*", "starttime + INTERVAL '24' HOUR AS endtime")

    masks = chartevents.filter(f"itemid = {rules.CPAP_ITEM} AND {matches_any('value', rules.CPAP_WORDS)}").select("stay_id", "charttime")
    windows = per_stay.select("subject_id", "stay_id", "starttime", "endtime")
    cpap = (
        events_in_window(masks, windows, ["stay_id"], "charttime", "starttime", "endtime")
        .filter("charttime > starttime").selectExpr("subject_id", "true AS cpap").distinct()
    )
    invasive = ventilation.filter(f"ventilation_status = {quote(rules.INVASIVE)}").selectExpr("stay_id", "true AS vent").distinct()
    service = first_per_key(services.filter("hadm_id IS NOT NULL"), ["hadm_id"], "transfertime ASC NULLS FIRST, curr_service ASC NULLS LAST")
    surgical = service.selectExpr("hadm_id", "coalesce(lower(curr_service) LIKE '%surg%', false) AS surgical")
    comorbid = code_flags(diagnoses_icd, ["hadm_id"], "icd_code", "icd_version", rules.SEVERITY_CODES)
    kind = first_match([
        ("admission_type = 'ELECTIVE' AND surgical", "ScheduledSurgical"),
        ("admission_type <> 'ELECTIVE' AND surgical", "UnscheduledSurgical"),
    ], "Medical")
    joined = (
        icustays.select(*STAY_KEYS)
        .join(per_stay.drop("subject_id"), "stay_id")
        .join(admissions.select("hadm_id", "admission_type"), "hadm_id")
        .join(surgical, "hadm_id", "left").join(comorbid, "hadm_id", "left")
        .join(invasive, "stay_id", "left").join(cpap, "subject_id", "left")
        .selectExpr("*", f"{kind} AS admissiontype", "CASE WHEN vent OR cpap THEN ratio_min END AS pao2fio2_vent_min")
    )
    scored = joined.selectExpr(*STAY_KEYS, "starttime", "endtime", *[f"{sql} AS {n}" for n, sql in saps_components().items()])
    total = scored.selectExpr("*", f"{score_total(SAPS_SCORES)} AS sapsii")
    return total.selectExpr(
        *STAY_KEYS, "starttime", "endtime", "sapsii", f"{logistic_risk('sapsii')} AS sapsii_prob", *SAPS_SCORES,
        f"{missing_pct(SAPS_SCORES)} AS percent_missing_value_sapsii",
    )


def sofa_components() -> dict[str, str]:
    return {
        "respiration": band_score("pao2fio2ratio", rules.RESPIRATION_POINTS, 0),
        "cns": rule_score([("gcs BETWEEN 13 AND 14", 1), ("gcs BETWEEN 10 AND 12", 2), ("gcs BETWEEN 6 AND 9", 3), ("gcs < 6", 4)],
                          0, present="gcs"),
        "cardiovascular": rule_score([
            ("rate_dopamine > 15 OR rate_epinephrine > 0.1D OR rate_norepinephrine > 0.1D", 4),
            ("rate_dopamine > 5 OR rate_epinephrine <= 0.1D OR rate_norepinephrine <= 0.1D", 3),
            ("rate_dopamine <= 5 OR rate_dobutamine IS NOT NULL", 2),
            ("meanbp < 70", 1),
            # every rate that is present has scored above
            ("meanbp IS NULL", None),
        ], 0),
        "liver": band_score("bilirubin", rules.LIVER_POINTS, 0),
        "coagulation": band_score("platelet", rules.COAGULATION_POINTS, 0),
        "renal": rule_score([
            ("creatinine >= 5 OR uo < 200", 4),
            ("creatinine >= 3.5D OR uo < 500", 3),
            ("creatinine >= 2", 2),
            ("creatinine >= 1.2D", 1),
            ("uo IS NULL AND creatinine IS NULL", None),
        ], 0),
    }


def sofa_days(wide: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """SOFA score per stay and calendar day of the bins; ``more``: further aggregates (SQL with alias) over the bins of the day."""
    aggs = {
        "pao2fio2ratio": "max", "platelet": "min", "bilirubin": "max", "meanbp": "min", "rate_dopamine": "max",
        "rate_norepinephrine": "max", "rate_epinephrine": "max", "rate_dobutamine": "max", "gcs": "min", "creatinine": "max",
        "uo": "sum",
    }
    daily = wide.groupBy(*STAY_KEYS, F.expr("cast(icu_day_start AS date) AS icu_day_start")).agg(
        *[F.expr(f"{f}({c}) AS {c}") for c, f in aggs.items()], *[F.expr(m) for m in more])
    scored = daily.selectExpr("*", *[f"{sql} AS {n}" for n, sql in sofa_components().items()])
    return scored.selectExpr(
        "stay_id", "subject_id", "hadm_id", "icu_day_start", "pao2fio2ratio", "gcs", "meanbp", "rate_dopamine",
        "rate_norepinephrine", "rate_epinephrine", "bilirubin", "platelet", "creatinine", "uo", *SOFA_SCORES,
        f"{missing_pct(SOFA_SCORES)} AS percentual_missing_value", f"{score_total(SOFA_SCORES)} AS sofa",
        *[c for c in daily.columns if c not in (*STAY_KEYS, "icu_day_start", *aggs)],
    )
