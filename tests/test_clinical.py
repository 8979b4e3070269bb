"""Pipeline stages on small hand-made tables with worked-out results."""

from datetime import date, datetime

import pytest

from tests.helpers import T0, at, rows, same
from tidespan.plans import measurements, severity, stays, treatments, ventilation
from tidespan.plans.pipeline import STAGES, WIDE, Options, Pipeline
from tidespan.sources.contracts import CLINICAL, conform, struct
from tidespan.sources.registry import Sources
from tidespan.sources.recast import clinical_sources

STAY = "subject_id long, hadm_id long, stay_id long, icu_intime timestamp_ntz, icu_outtime timestamp_ntz"


def table(spark, name, *records):
    """A source table from dictionaries; columns left out are NULL."""
    schema = struct(CLINICAL[name])
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in records], schema)


@pytest.fixture(scope="module")
def stay(spark):
    # one stay of 20 hours: bins at 10:00, 14:00, 18:00, 22:00, 02:00, 06:00
    return spark.createDataFrame([(1, 10, 100, T0, at(20))], STAY)


IDS = {"subject_id": 1, "hadm_id": 10, "stay_id": 100}


# --- sources ---------------------------------------------------------------------------------------
def test_contracts(spark):
    df = spark.createDataFrame([(1, 2)], "hadm_id int, seq_num int")
    with pytest.raises(ValueError, match="icd_code"):
        conform(df, "diagnoses_icd")
    good = conform(spark.createDataFrame([(1, 2, "x", 9)], "hadm_id int, seq_num int, icd_code string, icd_version int"), "diagnoses_icd")
    assert good.schema["hadm_id"].dataType.simpleString() == "bigint"
    with pytest.raises(KeyError):
        Sources(spark)("patients")
    assert Sources(spark, frames={"services": table(spark, "services")})("services").count() == 0


# --- stays -----------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def demo(spark):
    people = [
        dict(subject_id=1, gender="F", anchor_age=60, anchor_year=2024, dod=date(2024, 1, 29)),
        dict(subject_id=2, gender="M", anchor_age=17, anchor_year=2023),
        dict(subject_id=3, gender="M", anchor_age=50, anchor_year=2024, dod=date(2024, 1, 2)),
        dict(subject_id=4, gender="F", anchor_age=70, anchor_year=2024),
        dict(subject_id=5, gender="F", anchor_age=70, anchor_year=2024),
    ]
    first = datetime(2024, 1, 1)
    admissions = [dict(subject_id=s, hadm_id=10 * s, admittime=first, dischtime=datetime(2024, 1, 3, 12), admission_type=t,
                       hospital_expire_flag=0) for s, t in [(1, "URGENT"), (2, "ELECTIVE"), (3, "ELECTIVE"), (4, "OTHER"), (5, "URGENT")]]
    admissions.append(dict(subject_id=1, hadm_id=11, admittime=datetime(2024, 2, 1), dischtime=datetime(2024, 2, 2), admission_type="URGENT",
                           hospital_expire_flag=1))
    icu = [dict(subject_id=s, hadm_id=10 * s, stay_id=100 * s, intime=T0, outtime=at(36)) for s in (1, 2, 3, 4, 5)]
    icu += [dict(subject_id=1, hadm_id=10, stay_id=101, intime=at(40), outtime=at(50)),
            dict(subject_id=1, hadm_id=11, stay_id=102, intime=datetime(2024, 2, 1, 1), outtime=datetime(2024, 2, 1, 9))]
    chart = [dict(subject_id=s, stay_id=1, itemid=1, value=v) for s, v in [(1, "Full code"), (2, "x"), (3, None), (4, "DNR / DNI")]]
    return stays.demographics(stays.admitted_stays(table(spark, "patients", *people), table(spark, "admissions", *admissions),
                                                   table(spark, "icustays", *icu)), table(spark, "chartevents", *chart)).persist()


def test_demographics(demo):
    assert tuple(demo.columns) == stays.DEMOGRAPHICS
    assert rows(demo, "stay_id", "age", "admission_type", "dnr", "hospmort28day", "hospmort90day", "icumort", "hospstay_seq", "icustay_seq") == [
        (100, 60.0, "postSurgical ", 0, 0, 1, 0, 1, 1),     # dies exactly 28 days after admission: not counted
        (101, 60.0, "postSurgical ", 0, 0, 1, 0, 1, 2),
        (102, 60.0, "postSurgical ", 0, 1, 1, 0, 2, 1),
        (200, 18.0, "intensiveCare", 0, 0, 0, 0, 1, 1),
        (300, 50.0, "intensiveCare", 0, 1, 1, 1, 1, 1),
        (400, 70.0, None, 1, 0, 0, 0, 1, 1),
        (500, 70.0, "postSurgical ", None, 0, 0, 0, 1, 1),  # no chart rows: DNR unknown
    ]
    assert rows(demo.filter("stay_id = 100"), "los_hospital_day", "los_icu_day") == [(2.5, 1.5)]


def test_cohort(demo):
    assert rows(stays.cohort(demo), "stay_id") == [(100,), (200,), (300,)]


def test_body_size(spark, stay):
    height = table(spark, "height", *[dict(stay_id=100, charttime=t, height=h) for t, h in
                                      [(at(-6), 170.0), (at(24), 180.0), (at(-6, -1), 100.0), (at(24, 1), 100.0)]])
    weight = table(spark, "weight_durations", *[dict(stay_id=100, starttime=t, weight=w, weight_type=k) for t, w, k in
                                                [(at(-1000), 70.0, "admit"), (at(24), 80.0, "admit"), (at(25), 200.0, "admit"), (T0, 300.0, "daily")]])
    assert rows(stays.body_size(stay, height, weight)) == [(1, 100, 75.0, 175.0, 24.49)]
    empty = stays.body_size(stay, height.limit(0), weight.limit(0))
    assert rows(empty) == [(1, 100, None, None, None)]


def test_comorbidity(spark):
    people = spark.createDataFrame([(1, 10, 80.0), (2, 20, 49.0)], "subject_id long, hadm_id long, age double")
    codes = [("41071", 9), ("K704", 10), ("K700", 10), ("25040", 9), ("E109", 10), ("C80", 10), ("C349", 10), ("042", 9), ("042", 10)]
    got = stays.comorbidity(people, table(spark, "diagnoses_icd", *[dict(hadm_id=10, seq_num=1, icd_code=c, icd_version=v) for c, v in codes]))
    # age 4 + infarct 1 + max(1, 3) + max(2, 1) + max(2, 6) + 6
    assert rows(got, "hadm_id", "age_score", "charlson_comorbidity_index", "severe_liver_disease", "renal_disease") == [(10, 4, 22, 1, 0), (20, 0, 0, 0, 0)]


# --- measurements ----------------------------------------------------------------------------------
def test_vasopressors(spark):
    def drip(item, rate, unit="mcg/kg/min", weight=80.0):
        return dict(stay_id=100, starttime=T0, itemid=item, rate=rate, rateuom=unit, patientweight=weight)

    got = measurements.vasopressors(table(
        spark, "inputevents", drip(221906, 0.1), drip(221906, 0.0002, "mg/kg/min"), drip(221662, 5.0), drip(222315, 0.04, "units/min"),
        drip(221653, 10.0), drip(221289, 0.05), drip(999, 9.0)))
    (row,) = got.collect()
    assert (row.rate_norepinephrine, row.rate_dopamine, row.rate_vasopressin) == (0.2, 5.0, 2.4)
    assert row.vaso_total == pytest.approx(0.2 + 0.05 + 2.4 * 8.33 + 0.1 + 0.05)
    one = measurements.vasopressors(table(spark, "inputevents", drip(221906, 0.3, "mg/kg/min", 1.0)))
    assert rows(one, "rate_norepinephrine", "vaso_total") == [(0.3, 0.3)]


def test_urine(spark, stay):
    events = table(spark, "outputevents", *[dict(IDS, charttime=t, itemid=i, value=v) for t, i, v in
                                            [(at(1), 226559, 100.0), (at(1), 226560, 50.0), (at(1), 227488, 900.0), (at(4), 226559, 30.0)]])
    urine = measurements.urine_output(events)
    assert rows(urine, "charttime", "urineoutput") == [(at(1), 150.0), (at(4), 30.0)]
    assert rows(measurements.urine_bins(urine, stay)) == [(100, 0, 90.0), (100, 1, 30.0)]
    assert rows(measurements.urine_bins(urine, stay, "sum")) == [(100, 0, 180.0), (100, 1, 30.0)]


def test_labs(spark):
    lab = table(spark, "labevents", *[dict(subject_id=1, hadm_id=h, charttime=t, itemid=i, valuenum=v) for h, t, i, v in [
        (10, T0, 50813, 2.0), (10, T0, 50813, 4.0), (10, T0, 50813, 50.0), (10, T0, 50862, 10.0), (10, at(1), 51221, 30.0),
        (10, at(5), 50821, 90.0), (11, at(5), 50821, 10.0), (10, at(9), 50820, 7.1), (10, T0, 1, 5.0)]])
    chart = table(spark, "chartevents", *[dict(IDS, charttime=t, itemid=i, valuenum=v) for t, i, v in [
        (at(-2), 220224, 70.0), (at(-1), 220224, 80.0), (at(-1), 220224, 84.0), (at(-2, -1), 220235, 40.0), (at(9, 1), 220224, 1.0)]])
    got = measurements.lab_values(lab, chart)
    assert got.columns == ["subject_id", "charttime", *measurements.LAB_COLUMNS]
    assert rows(got, "charttime", "lactate", "albumin", "pao2", "paco2", "ph") == [
        (T0, 3.0, None, 82.0, None, None),      # charted pCO2 is a second too old
        (at(1), None, None, 82.0, None, None),  # a hematocrit makes a time point
        (at(5), None, None, 90.0, None, None),  # the lower admission id stands
        (at(9), None, None, None, None, 7.1),
    ]


def test_vital_signs(spark):
    def row(t, item, v, text=None):
        return dict(IDS, charttime=t, itemid=item, valuenum=v, value=text)

    got = measurements.vital_signs(table(
        spark, "chartevents",
        row(T0, 220045, 80.0), row(T0, 220045, 80.0), row(T0, 220045, 91.0), row(T0, 220179, 400.0), row(T0, 223761, 104.0),
        row(T0, 223762, 39.5), row(T0, 220277, 100.0), row(T0, 223901, 4.0), row(T0, 223900, 3.0), row(T0, 220739, 2.0),
        row(at(1), 223901, 5.0),                                              # verbal and eyes from the row before
        row(at(7), 220739, 1.0),                                              # exactly 6 h later: defaults
        row(at(8), 223900, 0.0, "No Response-ETT"), row(at(9), 223901, 1.0),  # tube: 15, then 15 again
        row(at(10), 223900, 2.0), row(at(20), 220045, 60.0)))
    # equal heart rates count once: mean of 80 and 91 is 85.5, to even
    assert rows(got, "charttime", "gcs", "heartrate", "sysbp", "tempc", "spo2") == [
        (T0, 9.0, 86.0, None, 40.0, 100.0),
        (at(1), 10.0, None, None, None, None),
        (at(7), 12.0, None, None, None, None),
        (at(8), 15.0, None, None, None, None),
        (at(9), 15.0, None, None, None, None),
        (at(10), 7.0, None, None, None, None),
        (at(20), None, 60.0, None, None, None),
    ]


def test_vital_after_tube_does_not_use_previous(spark):
    def row(t, item, v):
        return dict(IDS, charttime=t, itemid=item, valuenum=v)

    got = measurements.vital_signs(table(spark, "chartevents", row(T0, 223900, 0.0), row(T0, 223901, 1.0), row(at(1), 223900, 4.0)))
    # previous motor 1 is ignored after a tube: 6 + 4 + 4
    assert rows(got, "gcs") == [(14.0,), (15.0,)]


def test_coma_rows_of_one_time(spark):
    """Most components first, then without tube, then the lowest score; all vital signs of stay and time get it."""
    def row(hadm, t, item, v, stay=100, subject=1, text=None):
        return dict(subject_id=subject, hadm_id=hadm, stay_id=stay, charttime=t, itemid=item, valuenum=v, value=text)

    got = measurements.vital_signs(table(
        spark, "chartevents",
        row(10, T0, 223901, 3.0), row(20, T0, 223901, 1.0), row(20, T0, 220739, 1.0), row(10, T0, 220045, 70.0),
        row(10, at(30), 223901, 6.0), row(20, at(30), 223901, 2.0),
        row(10, at(60), 220045, 50.0, None), row(10, at(60), 223901, 4.0, None), row(30, at(61), 223901, 5.0, None, 2), row(30, at(61), 220739, 1.0, None, 2)))
    found = rows(got, "hadm_id", "stay_id", "charttime", "gcs", "heartrate")
    assert sorted(found, key=str) == sorted([
        (10, 100, T0, 7.0, 70.0),          # two components of admission 20 beat one of admission 10; its own row is not shown
        (20, 100, at(30), 11.0, None),     # equal components (motor known in both): the lower score
        (10, None, at(60), None, 50.0), (10, None, at(60), 13.0, None),  # without stay nothing is joined
        (30, None, at(61), 11.0, None),    # and nothing is taken from another patient's row an hour before
    ], key=str)


# --- treatments ------------------------------------------------------------------------------------
def infect(spark, stay, suspected, *cultures):
    soi = table(spark, "suspicion_of_infection", *[dict(subject_id=1, hadm_id=10, suspected_infection_time=t) for t in suspected])
    micro = table(spark, "microbiologyevents", *[dict(hadm_id=10, chartdate=d, spec_type_desc=s, org_name=o) for d, s, o in cultures])
    return rows(treatments.infection(stay, soi, micro), "infection_at_icu_admission", "site_of_infection")


def test_infection(spark, stay):
    day = date(2024, 1, 1)
    assert infect(spark, stay, []) == [(0, None)]
    assert infect(spark, stay, [None]) == [(0, None)]
    assert infect(spark, stay, [at(48)]) == [(1, "Sconosciuto")]
    assert infect(spark, stay, [at(48, 1)], (date(2024, 1, 3), "URINE", None)) == [(0, None)]
    assert infect(spark, stay, [at(-500)], (day, "URINE", None)) == [(1, "Sconosciuto")]
    assert infect(spark, stay, [at(3), at(1)], (date(2024, 1, 2), "URINE", None), (day, "SPUTUM", None)) == [(1, "Polmone")]
    assert infect(spark, stay, [T0], (day, "BLOOD CULTURE", "Staphylococcus Aureus")) == [(1, "Endocardite sospetta")]
    assert infect(spark, stay, [T0], (day, "BLOOD CULTURE", "E. COLI")) == [(1, "Altro")]


ITEMS = [(1, "Propofol"), (2, "Propofol (Intubation)"), (3, "Midazolam (Versed)"), (4, "Sevoflurane"), (5, "Ketamine"), (6, "Olanzapine"),
         (7, "Rocuronium"), (8, "Furosemide (Lasix)")]


def items(spark):
    records = [dict(itemid=i, label=label, category="Medications", linksto="inputevents") for i, label in ITEMS]
    records += [dict(itemid=i, label=f"Blood {i}", category="Blood Products/Colloids", linksto="inputevents") for i in (20, 21)]
    records.append(dict(itemid=9, label="Ketamine", category="Ingredients", linksto="inputevents"))
    return table(spark, "d_items", *records)


def sedation(spark, stay, inputs, gases):
    given = table(spark, "inputevents", *[dict(IDS, starttime=t, itemid=i) for t, i in inputs])
    inhaled = table(spark, "procedureevents", *[dict(IDS, starttime=t, itemid=i) for t, i in gases])
    got = treatments.sedative_bins(treatments.sedative_events(given, inhaled, items(spark)), stay)
    return rows(got, "bin_index", "sedation_type")


def test_sedation_lists(spark, stay):
    assert sedation(spark, stay, [(at(1), 1), (at(2), 3), (at(2), 6)], []) == [(0, "benzodiazepines, neuroleptics, propofol")]
    assert sedation(spark, stay, [(at(1), 2)], []) == [(0, None)]                    # named otherwise: sedated without kind
    assert sedation(spark, stay, [(at(1), 9)], []) == []                             # an ingredient is no infusion
    assert sedation(spark, stay, [(at(4), 5)], []) == [(0, "ketamine"), (1, "ketamine")]
    assert sedation(spark, stay, [], [(at(1), 4)]) == [(0, "inhaledHalogenated")]
    # every pair of this bin is a benzodiazepine: the gas is hidden
    assert sedation(spark, stay, [(at(1), 3)], [(at(1), 4)]) == [(0, "benzodiazepines")]
    # a second infusion elsewhere gives a pair that shows it
    assert sedation(spark, stay, [(at(1), 3), (at(9), 3)], [(at(1), 4)]) == [(0, "benzodiazepines, inhaledHalogenated"), (2, "benzodiazepines")]
    # the gas in the bin hides propofol unless there is a gas outside the bin
    assert sedation(spark, stay, [(at(1), 1)], [(at(1), 4)]) == [(0, "inhaledHalogenated")]
    assert sedation(spark, stay, [(at(1), 1)], [(at(1), 4), (at(19), 4)]) == [(0, "inhaledHalogenated, propofol"), (4, "inhaledHalogenated")]


def test_opioids_and_neuroblock(spark, stay):
    drugs = table(spark, "prescriptions", *[dict(subject_id=1, hadm_id=10, drug=d, starttime=a, stoptime=b) for d, a, b in [
        ("Morphine Sulfate", at(-9), at(1)), ("FENTANYL", at(9), None), ("Aspirin", T0, at(20)), ("oxycodone", at(17), at(18))]])
    assert rows(treatments.opioid_bins(drugs, stay), "bin_index") == [(0,), (4,)]
    given = table(spark, "inputevents", dict(IDS, starttime=at(4), itemid=7), dict(IDS, starttime=at(1), itemid=1))
    assert rows(treatments.neuroblock_bins(given, items(spark), stay), "bin_index") == [(0,), (1,)]


def test_lookback_flags(spark, stay):
    inputs = table(spark, "inputevents", dict(IDS, starttime=at(1), itemid=8), dict(IDS, starttime=at(15), itemid=20), dict(IDS, starttime=at(21), itemid=21),
                   dict(IDS, starttime=T0, itemid=21), dict(IDS, stay_id=7, starttime=T0, itemid=8))
    procedures = table(spark, "procedureevents", dict(IDS, starttime=at(1), endtime=at(8), itemid=225802), dict(IDS, starttime=at(9), itemid=225955))
    codes = table(spark, "procedures_icd", dict(subject_id=1, hadm_id=10, icd_code="0012", chartdate=date(2024, 1, 1)),
                  dict(subject_id=1, hadm_id=10, icd_code="3E0F7SD", chartdate=date(2024, 1, 2)))
    chart = table(spark, "chartevents", dict(IDS, charttime=at(9), itemid=224093, value="Prone"), dict(IDS, charttime=at(1), itemid=224093, value="Supine"))
    drugs = table(spark, "prescriptions", dict(subject_id=1, hadm_id=10, drug="Dexamethasone", starttime=at(2), stoptime=at(12)))
    events = treatments.lookback_events(inputs, procedures, codes, chart, drugs, items(spark))
    got = treatments.lookback_flag_bins(events, stay)
    flags = {f: [r[0] for r in rows(got.filter(f"{f} = 1"), "bin_index")] for f in
             ("crrt_24h", "ino_24h", "diuretic_24h", "prone_24h", "steroid_24h", "transfusion_24h")}
    assert flags == {
        "crrt_24h": [1, 2],            # the open one ends after an hour, before the next bin
        "ino_24h": [4, 5],             # on the day of admission midnight lies before the stay
        "diuretic_24h": [1, 2, 3, 4, 5],
        "prone_24h": [3, 4, 5],
        "steroid_24h": [1, 2, 3],
        "transfusion_24h": [1, 2, 3, 4, 5],
    }
    assert rows(treatments.transfusion_types(inputs, items(spark), stay)) == [(100, "Blood 21")]


def test_admission_reason(spark):
    people = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "subject_id long, hadm_id long")
    titles = table(spark, "d_icd_diagnoses", *[dict(icd_code=c, icd_version=v, long_title=t) for c, v, t in [
        ("A", 10, "Sepsis with shock"), ("B", 9, "Coma after hemorrhage"), ("C", 9, None)]])
    codes = table(spark, "diagnoses_icd", *[dict(hadm_id=h, seq_num=s, icd_code=c, icd_version=v) for h, s, c, v in [
        (10, 1, "A", 9), (20, 1, "B", 9), (20, 2, "A", 10), (20, 3, "T8112XA", 10), (20, 4, "51881", 9), (30, 1, "C", 9)]])
    assert rows(treatments.admission_reason(people, codes, titles), "hadm_id", "septic_shock", "ards", "admission_category") == [
        (10, 0, 0, "Altro"), (20, 1, 1, "Insufficienza neurologica centrale"), (30, 0, 0, None)]


# --- ventilation -----------------------------------------------------------------------------------
def settings(spark, *records):
    return table(spark, "ventilator_setting", *[dict(subject_id=1, stay_id=100, **r) for r in records])


def test_ventilation_episodes(spark, stay):
    vent = settings(
        spark, dict(charttime=at(-1), ventilator_mode="CMV"), dict(charttime=at(1), ventilator_mode="Standby"), dict(charttime=at(2), ventilator_mode="SPONT"),
        dict(charttime=at(3), ventilator_mode="CMV"), dict(charttime=at(5), ventilator_mode="APRV"), dict(charttime=at(6), ventilator_mode_hamilton="NIV"),
        dict(charttime=at(8), ventilator_mode_hamilton="DuoPaP"), dict(charttime=at(9), ventilator_mode_hamilton="DuoPaP"), dict(charttime=at(12)))
    oxygen = table(spark, "oxygen_delivery", *[dict(stay_id=100, charttime=t, o2_delivery_device_1=d) for t, d in [
        (at(2), "Endotracheal tube"), (at(8), "Tracheostomy tube"), (at(9), "Trach mask "), (at(12), "Trach mask")]])
    got = ventilation.ventilation_episodes(stay, vent, oxygen)
    # CMV at -1 h joins the run of 2 h (the row between has no status), which so starts before the stay
    assert rows(got, "starttime", "endtime") == []
    inside = ventilation.ventilation_episodes(stay, vent.filter(f"charttime > TIMESTAMP_NTZ'{at(0)}'"), oxygen)
    assert rows(inside, "starttime", "endtime", "is_tracheo", "tracheo_ts", "ventduration", "num_event", "end_mech_vent", "time_no_mech_vent") == [
        (at(2), at(6), 0, None, 4.0, 1, at(6), None)]


def test_vent_param_and_intubation(spark, stay):
    full = dict(peep=5.0, fio2=40.0, tidal_volume_observed=400.0)
    vent = settings(
        spark, dict(full, charttime=at(1), ventilator_mode="CMV"), dict(charttime=at(2), tidal_volume_observed=1500.0, tidal_volume_set=300.0),
        dict(full, charttime=at(5), ventilator_mode="Standby"), dict(full, charttime=at(9), ventilator_mode_hamilton="ASV", ventilator_type="Hamilton"),
        dict(charttime=at(30), peep=1.0))
    episodes = spark.createDataFrame(
        [(100, T0, at(20), at(1), at(13), None, 0, 12.0, 1, at(16), 1.0), (100, T0, at(20), at(14), at(16), None, 0, 2.0, 2, at(16), None)],
        "stay_id long, icu_intime timestamp_ntz, icu_outtime timestamp_ntz, starttime timestamp_ntz, endtime timestamp_ntz, "
        "tracheo_ts timestamp_ntz, is_tracheo int, ventduration double, num_event long, end_mech_vent timestamp_ntz, time_no_mech_vent double")
    of = ventilation.ventilated(stay, episodes)
    spine = Pipeline(Sources(spark)).spine(of)
    params = ventilation.vent_param(spine, ventilation.ventilator_bins(vent, of), ventilation.settings_outside(vent, of))
    assert rows(params, "icu_day_start", "tidal_volume", "peep", "vent_mode") == [
        (None, None, None, None), (T0, 400.0, 5.0, "CMV"), (at(4), 400.0, 5.0, "Standby"), (at(8), 400.0, 5.0, "ASV"),
        (at(12), None, None, None), (at(16), None, None, None), (at(20), None, None, None)]
    got = ventilation.intubation(params, episodes, stay)
    assert rows(got, "icu_day_start", "is_intubated", "intubation_time", "next_intubation_time") == [
        (None, 0, None, None), (T0, 1, at(1), at(14)), (at(4), 0, at(1), at(14)), (at(8), 1, at(1), at(14)),
        (at(12), 1, at(1), at(14)), (at(12), 1, at(14), None), (at(16), 1, at(14), None), (at(20), 0, None, None)]
    assert ventilation.intubation(params, episodes, stay, one_row_per_bin=True).count() == 7


@pytest.mark.parametrize("tracheo, peep, fio2, volume, mode, kind, expected", [
    (0, 5.0, 40.0, 400.0, "CMV", None, 1), (0, 5.0, 40.0, 400.0, "CMV", "Hamilton", 0), (0, 5.0, 40.0, 400.0, "ASV", "Hamilton", 1),
    (0, 5.0, 40.0, 400.0, "ASV", "Drager", 0), (0, None, 40.0, 400.0, "CMV", None, 1), (0, 5.0, 40.0, 400.0, None, None, 1),
    (1, 5.0, 40.0, 400.0, "Standby", None, 1), (1, None, 40.0, None, None, None, 0), (1, None, None, 400.0, "CMV", None, 0),
])
def test_intubation_arms(spark, tracheo, peep, fio2, volume, mode, kind, expected):
    df = spark.createDataFrame([(T0, tracheo, peep, fio2, volume, mode, kind)],
                               "intubation_time timestamp_ntz, is_tracheo int, peep double, fio2 double, tidal_volume double, vent_mode string, vent_type string")
    assert df.selectExpr(ventilation.intubation_expression()).first()[0] == expected
    assert df.selectExpr("cast(NULL AS timestamp_ntz) AS intubation_time", *df.columns[1:]).selectExpr(ventilation.intubation_expression()).first()[0] == 0


# --- scores ----------------------------------------------------------------------------------------
def points(spark, sql, **values):
    columns = ", ".join(f"cast({'NULL' if v is None else v} AS double) AS {n}" for n, v in values.items())
    return spark.sql(f"SELECT {sql} FROM (SELECT {columns})").first()[0]


@pytest.mark.parametrize("name, column, expected", [
    ("respiration", "pao2fio2ratio", {99: 4, 100: 3, 199: 3, 200: 2, 299: 2, 300: 1, 399: 1, 400: 0, None: None}),
    ("cns", "gcs", {15: 0, 14: 1, 13: 1, 12: 2, 10: 2, 9: 3, 6: 3, 5: 4, None: None}),
    ("liver", "bilirubin", {1.1: 0, 1.2: 1, 1.9: 1, 2: 2, 5.9: 2, 6: 3, 11.9: 3, 12: 4, None: None}),
    ("coagulation", "platelet", {19: 4, 20: 3, 49: 3, 50: 2, 99: 2, 100: 1, 149: 1, 150: 0, None: None}),
])
def test_sofa_bands(spark, name, column, expected):
    assert {v: points(spark, severity.sofa_components()[name], **{column: v}) for v in expected} == expected


def test_sofa_circulation_and_kidney(spark):
    def heart(dopamine=None, epinephrine=None, norepinephrine=None, dobutamine=None, meanbp=None):
        return points(spark, severity.sofa_components()["cardiovascular"], rate_dopamine=dopamine, rate_epinephrine=epinephrine,
                      rate_norepinephrine=norepinephrine, rate_dobutamine=dobutamine, meanbp=meanbp)

    assert [heart(dopamine=16), heart(epinephrine=0.11), heart(norepinephrine=0.1), heart(dopamine=15), heart(dopamine=5),
            heart(dobutamine=1), heart(meanbp=69), heart(meanbp=70), heart()] == [4, 4, 3, 3, 2, 2, 1, 0, None]

    def kidney(creatinine=None, uo=None):
        return points(spark, severity.sofa_components()["renal"], creatinine=creatinine, uo=uo)

    assert [kidney(5), kidney(1, 199), kidney(3.5, 900), kidney(1, 499), kidney(2, 500), kidney(1.2), kidney(1.1), kidney(uo=500), kidney()] == [
        4, 4, 3, 3, 2, 1, 0, 0, None]


@pytest.mark.parametrize("name, column, expected", [
    ("age_score", "age", {39: 0, 40: 7, 59: 7, 60: 12, 70: 15, 75: 16, 80: 18, None: None}),
    ("pao2fio2_score", "pao2fio2_vent_min", {99: 11, 100: 9, 199: 9, 200: 6, None: None}),
    ("uo_score", "urineoutput", {499: 11, 500: 4, 999: 4, 1000: 0, None: None}),
    ("bun_score", "bun_max", {27: 0, 28: 6, 83: 6, 84: 10, None: None}),
    ("bicarbonate_score", "bicarbonate_min", {14: 6, 15: 3, 19: 3, 20: 0, None: None}),
    ("bilirubin_score", "bilirubin_max", {3.9: 0, 4: 4, 5.9: 4, 6: 9, None: None}),
    ("gcs_score", "mingcs", {2: None, 3: 26, 5: 26, 6: 13, 8: 13, 9: 7, 10: 7, 11: 5, 13: 5, 14: 0, 15: 0, None: None}),
])
def test_saps_bands(spark, name, column, expected):
    assert {v: points(spark, severity.saps_components()[name], **{column: v}) for v in expected} == expected


@pytest.mark.parametrize("name, column, expected", [
    ("hr_score", "heartrate", {(39, 170): 11, (40, 160): 7, (40, 159): 4, (40, 120): 4, (69, 119): 2, (70, 119): 0, (None, None): None}),
    ("sysbp_score", "sysbp", {(69, 210): 13, (70, 150): 5, (99, 200): 5, (100, 200): 2, (100, 199): 0, (None, None): None}),
    ("temp_score", "tempc", {(30, 39): 3, (30, 38.9): 0, (None, None): None}),
    ("wbc_score", "wbc", {(0.9, 30): 12, (1, 20): 3, (1, 19.9): 0, (None, None): None}),
    ("potassium_score", "potassium", {(2.9, 4): 3, (3, 5): 3, (3, 4.9): 0, (None, None): None}),
    ("sodium_score", "sodium", {(124, 150): 5, (125, 145): 1, (125, 144): 0, (None, None): None}),
])
def test_saps_two_sided(spark, name, column, expected):
    sql = severity.saps_components()[name]
    assert {k: points(spark, sql, **{f"{column}_min": k[0], f"{column}_max": k[1]}) for k in expected} == expected


def test_saps_rows(spark):
    wide = spark.createDataFrame(
        [(1, 100, T0, at(4 * i), 65.0, *[v] * 11, 14.0) for i, v in enumerate((150.0, 90.0))],
        "subject_id long, stay_id long, icu_intime timestamp_ntz, icu_day_start timestamp_ntz, age double, heartrate double, sysbp double, "
        "tempc double, bun double, wbc double, potassium double, sodium double, bicarbonate double, bilirubin double, uo double, "
        "pao2fio2ratio double, gcs double")
    icu = table(spark, "icustays", dict(IDS, intime=T0, outtime=at(30)))
    admission = table(spark, "admissions", dict(subject_id=1, hadm_id=10, admission_type="ELECTIVE"))
    codes = table(spark, "diagnoses_icd", dict(hadm_id=10, icd_code="20300", icd_version=9))
    empty = {n: table(spark, n) for n in ("services", "ventilation", "chartevents")}

    def score(**given):
        t = {**empty, **given}
        (row,) = severity.saps(wide, icu, admission, t["services"], codes, t["ventilation"], t["chartevents"]).collect()
        return row

    plain = score()
    assert (plain.hr_score, plain.pao2fio2_score, plain.comorbidity_score, plain.admissiontype_score, plain.uo_score) == (4, None, 10, 6, 11)
    assert plain.percent_missing_value_sapsii == 6 and plain.endtime == at(24)
    tube = score(ventilation=table(spark, "ventilation", dict(stay_id=100, ventilation_status="InvasiveVent")))
    assert tube.pao2fio2_score == 11 and tube.sapsii == plain.sapsii + 11

    def mask(t, text="CPAP mask "):
        return score(chartevents=table(spark, "chartevents", dict(IDS, charttime=t, itemid=226732, value=text))).pao2fio2_score

    assert [mask(T0), mask(at(0, 1)), mask(at(24)), mask(at(24, 1)), mask(at(1), "Nasal")] == [None, 11, 11, None, None]
    services = table(spark, "services", dict(hadm_id=10, transfertime=T0, curr_service="MED"), dict(hadm_id=10, curr_service="CSURG"))
    assert score(services=services).admissiontype_score == 0   # a missing time comes first


# --- whole pipeline --------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def pipeline(spark, tiny):
    return Pipeline(clinical_sources(spark, tiny))


def test_wide_schema_and_keys(pipeline):
    assert len(WIDE) == 73 and tuple(pipeline.wide_table.columns) == WIDE
    assert len(pipeline.overalltable2_table.columns) == 85
    wide = pipeline.wide_table
    assert wide.count() == wide.select("stay_id", "icu_day_start").distinct().count() > 0
    assert wide.filter("subject_id IS NULL OR icu_day_start IS NULL").count() == 0


def test_options(spark, tiny, pipeline):
    other = Pipeline(clinical_sources(spark, tiny), Options(ratio_numerator="pao2", urine="sum", saps_hours=24, one_row_per_bin=True,
                                                            rows_without_bin=False))
    other.__dict__.update(cohort_table=pipeline.cohort_table, vent_time_table=pipeline.vent_time_table)
    assert other.vent_param().filter("icu_day_start IS NULL").count() == 0
    keys = other.prova_intubation().groupBy("stay_id", "icu_day_start").count()
    assert keys.filter("count > 1").count() == 0
    wide = other.overalltable1()
    assert wide.filter("abs(pao2fio2ratio - 100 * pao2 / nullif(fio2, 0)) > 0.001").count() == 0
    assert wide.agg({"uo": "sum"}).first()[0] >= pipeline.wide_table.agg({"uo": "sum"}).first()[0]


def test_close_deletes_the_intermediate_tables(spark, tiny):
    with Pipeline(clinical_sources(spark, tiny)) as p:
        assert p.cohort_table.count() > 0
        paths = list(p._made)
        files = spark.sparkContext._jvm.java.io.File
        assert paths and all(files(path).exists() for path in paths)
    assert not any(files(path).exists() for path in paths)


def test_write_reuses_what_it_wrote(spark, tiny, tmp_path):
    p = Pipeline(clinical_sources(spark, tiny))
    p.write(str(tmp_path), ("bmi", "cohort"))
    assert p.cohort_table.inputFiles()[0].startswith(f"file://{tmp_path}/cohort")
    assert not any("/cohort-" in path for path in p._made)


def test_write(pipeline, tmp_path):
    written = pipeline.write(str(tmp_path), ("vasopressors", "cohort"))
    assert written["vasopressors"].count() == pipeline.vasopressors().count()
    again = pipeline.write(str(tmp_path), ("cohort",))
    assert again["cohort"].count() == pipeline.cohort_table.count()
    assert len(STAGES) == 28


def exchanges(spark, df) -> list[str]:
    """Keys of the exchanges when nothing is broadcast."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = df.select("*")._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    return [x for x in lines if "Exchange hashpartitioning" in x]


def test_wide_rows_pass_one_join(spark, pipeline):
    assert not {"weight", "heartrate"} & set(pipeline.scored_bins.columns)
    assert len(exchanges(spark, pipeline.overalltable2())) == 2  # the wide rows and the scored bins
    picked = pipeline.overalltable2_table.groupBy("subject_id").agg({"is_intubated": "max", "ph": "max"}).filter("`max(is_intubated)` > 0 AND `max(ph)` IS NOT NULL")
    same(pipeline.final_data(), pipeline.overalltable2_table.join(picked.select("subject_id"), "subject_id", "left_semi"))


def test_vital_signs_of_stays(spark, pipeline):
    of = pipeline.ventilated_stays
    got = pipeline.getallvitalsigns(of)
    assert not any("measure" in x for x in exchanges(spark, got))
    assert len(same(got, pipeline.getallvitalsigns().join(of.select("stay_id"), "stay_id", "left_semi"))) > 0
