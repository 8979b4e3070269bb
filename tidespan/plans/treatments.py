"""Infection, drugs, treatments of the last day and the reason for admission."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidespan.functions.temporal import plus_hours
from tidespan.functions.text import classify_text, first_match, in_list, matches_any, quote
from tidespan.operators.bins import bin_aggregate, covered_bins, events_in_window, lookback_bins
from tidespan.operators.codes import code_flags
from tidespan.plans import rules

ADMISSION_KEYS = ["subject_id", "hadm_id"]
BIN = ["stay_id", "bin_index"]


def infection(stays: DataFrame, suspicion_of_infection: DataFrame, microbiologyevents: DataFrame) -> DataFrame:
    """Suspected infection up to 48 hours after admission and the site of its first culture.

    The first suspicion of the admission counts; of its cultures within a day the first by date, then by site
    name.
    """
    keys = ["subject_id", "hadm_id", "stay_id"]
    first = suspicion_of_infection.groupBy(*ADMISSION_KEYS).agg(F.expr("min(suspected_infection_time) AS suspected"))
    spec, org = "lower(spec_type_desc)", "lower(org_name)"
    site = first_match(
        [(in_list(spec, names), label) for label, names in rules.INFECTION_SITES]
        + [(f"{spec} LIKE '%blood culture%' AND {in_list(org, rules.ENDOCARDITIS_ORGANISMS)}", rules.ENDOCARDITIS_SITE),
           (f"{spec} IS NULL", rules.UNKNOWN_SITE)],
        rules.OTHER,
    )
    # a day and site once per admission, however many cultures it stands for
    cultures = microbiologyevents.selectExpr("hadm_id", "chartdate", f"{site} AS site").distinct()
    suspected = stays.join(first, ADMISSION_KEYS, "left")
    windows = suspected.select("hadm_id", "stay_id", "suspected")
    near = events_in_window(cultures, windows, ["hadm_id"], "chartdate", plus_hours("suspected", -24), plus_hours("suspected", 24))
    sites = near.groupBy("stay_id").agg(F.expr("min(struct(chartdate, site)).site AS site"))
    flag = f"CASE WHEN suspected <= {plus_hours('icu_intime', 48)} THEN 1 ELSE 0 END"
    return suspected.join(sites, "stay_id", "left").selectExpr(
        *keys, "icu_intime", f"{flag} AS infection_at_icu_admission",
        f"CASE WHEN {flag} = 1 THEN coalesce(site, {quote(rules.UNKNOWN_SITE)}) END AS site_of_infection",
    )


# arms of the sedation label, in order; the label of a halogenated anaesthetic sits between the second
# and the third
SEDATIVE_LABELS = [
    (matches_any("label", rules.BENZODIAZEPINES), "benzodiazepines"),
    (matches_any("label", rules.NEUROLEPTICS), "neuroleptics"),
    ("lower(label) = 'propofol'", "propofol"),
    ("lower(label) = 'dexmedetomidine'", "dexmedetomidine"),
    ("lower(label) = 'haloperidol'", "haloperidol"),
    (matches_any("label", ("ketamine",)), "ketamine"),
]
HALOGENATED_LABEL = "inhaledHalogenated"


def sedative_events(inputevents: DataFrame, procedureevents: DataFrame, d_items: DataFrame) -> DataFrame:
    """Sedative infusions and inhaled anaesthetics: ``stay_id, starttime, label`` (label may be NULL).

    The dictionary is classified first; only its few matching items take part in the join.
    """
    either = " OR ".join([
        matches_any("label", (*rules.BENZODIAZEPINES, *rules.NEUROLEPTICS, "propofol", "dexmedetomidine", "haloperidol")),
        f"({matches_any('label', ('ketamine',))} AND category <> 'Ingredients' AND linksto = 'inputevents')",
    ])
    sedatives = d_items.filter(either).selectExpr("itemid", f"{first_match(SEDATIVE_LABELS)} AS label", "false AS inhaled")
    gases = d_items.filter(matches_any("label", rules.HALOGENATED)).selectExpr(
        "itemid", f"{quote(HALOGENATED_LABEL)} AS label", "true AS inhaled")
    columns = ["stay_id", "starttime", "label", "inhaled"]
    infused = inputevents.select("stay_id", "starttime", "itemid").join(sedatives, "itemid").select(*columns)
    return infused.unionByName(procedureevents.select("stay_id", "starttime", "itemid").join(gases, "itemid").select(*columns))


def sedative_bins(events: DataFrame, stays: DataFrame) -> DataFrame:
    """Per bin: any sedative, and the sorted list of its kinds.

    The list pairs every infusion of the stay with every inhaled anaesthetic of the stay and labels each
    pair by the first matching arm. Which labels appear follows from counts, without forming pairs: an inhaled
    label needs an infusion that is not itself labelled by the first two arms in this bin (or no infusion in
    the stay), the later arms need an inhaled event outside this bin (or none in the stay).
    """
    windows = stays.select("stay_id", "icu_intime", "icu_outtime")
    first_arms = in_list("label", [label for _, label in SEDATIVE_LABELS[:2]])
    labels = [label for _, label in SEDATIVE_LABELS]
    binned = bin_aggregate(
        events, windows, ["stay_id"], "starttime", "icu_intime", "icu_outtime",
        ["count_if(inhaled) AS here_inhaled", f"count_if({first_arms}) AS here_first",
         "count_if(own AND inhaled) AS own_inhaled", "count_if(own AND NOT inhaled) AS own_infused",
         *[f"max(label = '{label}') AS has_{label}" for label in labels]],
    )
    shown = {label: f"has_{label}" for label in labels[:2]}
    shown |= {label: f"has_{label} AND (n_inhaled > here_inhaled OR n_inhaled = 0)" for label in labels[2:]}
    shown[HALOGENATED_LABEL] = "here_inhaled > 0 AND (n_infused > here_first OR n_infused = 0)"
    listed = ", ".join(f"CASE WHEN {shown[label]} THEN '{label}' END" for label in sorted(shown, key=str.lower))
    # an event counts in its own bin alone, so the bins of a stay add up to its events
    of_stay = "OVER (PARTITION BY stay_id)"
    totals = binned.selectExpr("*", f"sum(own_inhaled) {of_stay} AS n_inhaled", f"sum(own_infused) {of_stay} AS n_infused")
    return totals.selectExpr(
        *BIN, "1 AS is_sedated", f"nullif(concat_ws(', ', {listed}), '') AS sedation_type"
    )


def opioid_prescriptions(prescriptions: DataFrame) -> DataFrame:
    return prescriptions.filter(matches_any("drug", rules.OPIOIDS))


def opioid_bins(prescriptions: DataFrame, stays: DataFrame, heavy: bool = True) -> DataFrame:
    """Bins touched by an opioid prescription; of equal starts only the longest matters. ``heavy``: as in ``salted_join``."""
    wanted = opioid_prescriptions(prescriptions)
    spans = wanted.groupBy(*ADMISSION_KEYS, "starttime").agg(F.expr("max(stoptime) AS stoptime"))
    hits = covered_bins(spans, stays, ADMISSION_KEYS, "starttime", "stoptime", "icu_intime", "icu_outtime", ["stay_id"], count_on=wanted,
                        apart=[*ADMISSION_KEYS, "starttime"], heavy=heavy)
    return hits.selectExpr(*BIN, "1 AS opioids")


def neuroblock_bins(inputevents: DataFrame, d_items: DataFrame, stays: DataFrame) -> DataFrame:
    """Bins in which a neuromuscular blocker was started."""
    items = d_items.filter(matches_any("label", rules.NEUROBLOCKERS)).select("itemid")
    events = inputevents.select("stay_id", "starttime", "itemid").join(items, "itemid").select("stay_id", "starttime")
    windows = stays.select("stay_id", "icu_intime", "icu_outtime")
    return bin_aggregate(events, windows, ["stay_id"], "starttime", "icu_intime", "icu_outtime", ["max(1) AS neuroblock"])


def drug_items(d_items: DataFrame) -> DataFrame:
    """Dictionary items that are diuretics or blood products."""
    diuretic, blood = matches_any("label", rules.DIURETICS), f"category = {quote(rules.BLOOD_CATEGORY)}"
    return d_items.selectExpr(
        "itemid", "label", f"coalesce({diuretic}, false) AS diuretic", f"coalesce({blood}, false) AS blood"
    ).filter("diuretic OR blood")


def lookback_events(inputevents: DataFrame, procedureevents: DataFrame, procedures_icd: DataFrame, chartevents: DataFrame,
                    prescriptions: DataFrame, d_items: DataFrame) -> DataFrame:
    """All events that set a look-back flag, in one long frame.

    ``event_stay`` limits an event to one stay (NULL: any stay of the admission); ``active_until`` is set for
    treatments that must still run at the bin.
    """
    no_end, any_stay = "cast(NULL AS timestamp_ntz) AS active_until", "cast(NULL AS bigint) AS event_stay"
    crrt = procedureevents.filter(f"stay_id IS NOT NULL AND {in_list('itemid', rules.CRRT_ITEMS)}").selectExpr(
        *ADMISSION_KEYS, "stay_id AS event_stay", "starttime AS time",
        f"coalesce(endtime, {plus_hours('starttime', 1)}) AS active_until", "'crrt_24h' AS flag")
    nitric = procedures_icd.filter(in_list("icd_code", rules.NITRIC_OXIDE_CODES)).selectExpr(
        *ADMISSION_KEYS, any_stay, "cast(chartdate AS timestamp_ntz) AS time", no_end, "'ino_24h' AS flag")
    prone = chartevents.filter(
        f"stay_id IS NOT NULL AND itemid = {rules.PRONE_ITEM} AND {in_list('value', rules.PRONE_VALUES)}"
    ).selectExpr(*ADMISSION_KEYS, "stay_id AS event_stay", "charttime AS time", no_end, "'prone_24h' AS flag")
    flags = "filter(array(CASE WHEN diuretic THEN 'diuretic_24h' END, CASE WHEN blood THEN 'transfusion_24h' END), f -> f IS NOT NULL)"
    items = drug_items(d_items).selectExpr("itemid", f"explode({flags}) AS flag")
    drugs = inputevents.filter("stay_id IS NOT NULL").select(*ADMISSION_KEYS, "stay_id", "starttime", "itemid").join(
        items, "itemid").selectExpr(*ADMISSION_KEYS, "stay_id AS event_stay", "starttime AS time", no_end, "flag")
    steroids = prescriptions.filter(matches_any("drug", rules.STEROIDS)).selectExpr(
        *ADMISSION_KEYS, any_stay, "starttime AS time",
        f"coalesce(stoptime, {plus_hours('starttime', 1)}) AS active_until", "'steroid_24h' AS flag")
    return reduce(DataFrame.unionByName, [crrt, nitric, prone, drugs, steroids])


def lookback_flag_bins(events: DataFrame, stays: DataFrame) -> DataFrame:
    """Every look-back flag of every bin from one join and one aggregate."""
    hits = lookback_bins(events, stays, ADMISSION_KEYS, "time", "icu_intime", "icu_outtime", "active_until")
    return hits.filter("event_stay IS NULL OR event_stay = stay_id").groupBy(*BIN).agg(
        *[F.expr(f"max(CASE WHEN flag = '{f}' THEN 1 END) AS {f}") for f in rules.LOOKBACK_FLAGS]
    )


def transfusion_types(inputevents: DataFrame, d_items: DataFrame, stays: DataFrame) -> DataFrame:
    """The last blood product by name among all of the stay."""
    items = drug_items(d_items).filter("blood").select("itemid", "label")
    keys = [*ADMISSION_KEYS, "stay_id"]
    events = inputevents.select(*keys, "starttime", "itemid").join(items, "itemid").select(*keys, "starttime", "label")
    inside = events_in_window(events, stays, keys, "starttime", "icu_intime", "icu_outtime")
    return inside.groupBy("stay_id").agg(F.expr("max(label) AS transfusion_type"))


def admission_reason(cohort: DataFrame, diagnoses_icd: DataFrame, d_icd_diagnoses: DataFrame) -> DataFrame:
    """Category of the primary diagnosis title, septic shock and ARDS codes of the admission."""
    titles = d_icd_diagnoses.groupBy("icd_code").agg(
        F.expr(f"max({classify_text('long_title', rules.ADMISSION_CATEGORIES, rules.OTHER)}) AS category"))
    primary = (
        diagnoses_icd.filter("seq_num = 1").select("hadm_id", "icd_code").distinct().join(titles, "icd_code")
        .groupBy("hadm_id").agg(F.expr("max(category) AS category"))
    )
    codes = code_flags(diagnoses_icd, ["hadm_id"], "icd_code", "icd_version", rules.ADMISSION_CODES)
    septic = quote(rules.SEPTIC_CATEGORY)
    return cohort.select(*ADMISSION_KEYS).join(codes, "hadm_id", "left").join(primary, "hadm_id", "left").selectExpr(
        *ADMISSION_KEYS, "septic_shock", "ards",
        f"CASE WHEN septic_shock = 0 AND category = {septic} THEN {quote(rules.OTHER)} ELSE category END AS admission_category",
    )
