"""Stays: demographics, cohort, body size, comorbidity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidespan.functions import scoring
from tidespan.functions.rounding import round_half_up
from tidespan.functions.temporal import age_at, days_between, died_within, micros, plus_hours
from tidespan.functions.text import first_match, in_list, quote
from tidespan.operators.bins import events_in_window
from tidespan.operators.codes import code_flags
from tidespan.operators.ranking import dense_rank_by_time
from tidespan.operators.skew import salted_join
from tidespan.plans import rules

DEMOGRAPHICS = (
    "subject_id", "hadm_id", "stay_id", "gender", "age", "dod", "admittime", "admission_type", "dischtime",
    "los_hospital_day", "dnr", "hospmort", "hospmort28day", "hospmort90day", "icumort", "icu_intime", "icu_outtime",
    "los_icu_day", "hospstay_seq", "icustay_seq",
)
COHORT = tuple(c for c in DEMOGRAPHICS if c not in ("dnr", "hospstay_seq", "icustay_seq"))


def admitted_stays(patients: DataFrame, admissions: DataFrame, icustays: DataFrame) -> DataFrame:
    """Stays with the columns of their admission and patient."""
    return icustays.join(admissions.withColumnRenamed("subject_id", "adm_subject_id"), "hadm_id").join(patients, "subject_id")


def demographics(stays: DataFrame, chartevents: DataFrame) -> DataFrame:
    """One row per stay with age, lengths of stay, outcomes and the rank of admission and stay.

    ``stays`` (``admitted_stays``) is read for the rows and for each rank, so hand in a written table.
    """
    dnr = chartevents.groupBy("subject_id").agg(
        F.expr(f"max(CASE WHEN value LIKE {quote(rules.DNR_TEXT)} THEN 1 ELSE 0 END) AS dnr")
    )
    ranked = dense_rank_by_time(stays, ["adm_subject_id"], "admittime", "hospstay_seq")
    ranked = dense_rank_by_time(ranked, ["hadm_id"], "intime", "icustay_seq")
    kind = first_match([(in_list("admission_type", types), label) for label, types in rules.ADMISSION_TYPES])
    rows = ranked.selectExpr(
        "subject_id", "hadm_id", "stay_id", "gender",
        f"round({age_at('anchor_age', 'anchor_year', 'admittime')}) AS age",
        "dod", "admittime", f"{kind} AS admission_type", "dischtime",
        f"{days_between('dischtime', 'admittime')} AS los_hospital_day",
        "hospital_expire_flag AS hospmort",
        f"{died_within('dod', 'admittime', 28)} AS hospmort28day",
        f"{died_within('dod', 'admittime', 90)} AS hospmort90day",
        f"CASE WHEN {micros('dod')} > {micros('intime')} AND {micros('dod')} < {micros('outtime')} THEN 1 ELSE 0 END AS icumort",
        "intime AS icu_intime", "outtime AS icu_outtime", f"{days_between('outtime', 'intime')} AS los_icu_day",
        "hospstay_seq", "icustay_seq",
    )
    return rows.join(dnr, "subject_id", "left").select(*DEMOGRAPHICS)


def cohort(demographics: DataFrame) -> DataFrame:
    """Adults in their first stay of their first admission, with known outcome and no DNR text."""
    return demographics.filter(
        "age >= 18 AND hospstay_seq = 1 AND icustay_seq = 1 AND hospmort IS NOT NULL AND icumort IS NOT NULL AND dnr = 0"
    ).select(*COHORT)


def stay_windows(cohort: DataFrame) -> DataFrame:
    """The key frame every later step joins to."""
    return cohort.select("subject_id", "hadm_id", "stay_id", "icu_intime", "icu_outtime")


def body_size(stays: DataFrame, height: DataFrame, weight_durations: DataFrame) -> DataFrame:
    """Mean height around admission, mean admission weight up to the first day, and the body-mass index."""
    keys = ["subject_id", "stay_id"]
    measured = events_in_window(height, stays, ["stay_id"], "charttime", plus_hours("icu_intime", -6), plus_hours("icu_intime", 24))
    heights = measured.groupBy(*keys).agg(F.expr(f"{round_half_up('avg(height)')} AS height"))
    admitted = weight_durations.filter("weight_type = 'admit'").select("stay_id", "starttime", "weight")
    weights = (
        salted_join(admitted, stays.select(*keys, "icu_intime"), ["stay_id"])
        .filter(f"starttime <= {plus_hours('icu_intime', 24)}")
        .groupBy(*keys).agg(F.expr("avg(weight) AS weight"))
    )
    sized = stays.select(*keys).join(weights, keys, "left").join(heights, keys, "left")
    return sized.selectExpr(
        *keys, "weight", "height", f"{round_half_up(scoring.safe_ratio('weight', 'pow(height / 100, 2)'))} AS bmi"
    )


def comorbidity(cohort: DataFrame, diagnoses_icd: DataFrame) -> DataFrame:
    """Comorbidity flags of the admission, age points and the weighted index."""
    flags = code_flags(diagnoses_icd, ["hadm_id"], "icd_code", "icd_version", rules.CHARLSON)
    joined = cohort.select("subject_id", "hadm_id", "age").join(flags, "hadm_id", "left").selectExpr(
        "subject_id", "hadm_id",
        f"{scoring.rule_score([(f'age {op} {limit}', p) for op, limit, p in rules.CHARLSON_AGE_POINTS], 4)} AS age_score",
        *[f"coalesce({name}, 0) AS {name}" for name in rules.CHARLSON],
    )
    index = " + ".join([
        "age_score",
        *rules.CHARLSON_SINGLE,
        "greatest(mild_liver_disease, 3 * severe_liver_disease)",
        "greatest(2 * diabetes_with_cc, diabetes_without_cc)",
        "greatest(2 * malignant_cancer, 6 * metastatic_solid_tumor)",
        "2 * paraplegia", "2 * renal_disease", "6 * aids",
    ])
    return joined.selectExpr("*", f"{index} AS charlson_comorbidity_index")


def all_demo_cohort(cohort: DataFrame, body_size: DataFrame, comorbidity: DataFrame) -> DataFrame:
    """The cohort with body size and comorbidity index (21 columns)."""
    index = comorbidity.selectExpr("subject_id", "hadm_id", "charlson_comorbidity_index AS comorb_score")
    return cohort.join(body_size, ["subject_id", "stay_id"], "left").join(index, ["subject_id", "hadm_id"], "left").select(
        *COHORT, "weight", "height", "bmi", "comorb_score"
    )
