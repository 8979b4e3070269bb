"""Clinical source tables derived from the generic ``events`` table.

There is no clinical data here, so the feature pipeline is exercised on tables that Spark derives from the
events: a user is a patient, the user's events are spread over one or two admissions and stays, and every
event yields observations whose codes and values follow from its id and value. The tables grow with the
events. Each column is an expression that Spark SQL and the SQL oracle read alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidespan.sources.contracts import column_types
from tidespan.sources.registry import Sources, materialize

# columns of the base frame, in order of definition
BASE = [
    ("id", "event_id"),
    ("subject_id", "user_id"),
    ("v", "value"),
    ("ts", "ts"),
    ("th", "CAST(date_trunc('hour', ts) AS TIMESTAMP_NTZ)"),
    ("dd", "CAST(EXTRACT(DAY FROM ts) AS BIGINT)"),
    ("hadm_id", "user_id * 10 + CASE WHEN user_id % 5 = 0 AND ts >= TIMESTAMP_NTZ '2024-01-16 00:00:00' THEN 2 ELSE 1 END"),
]
STAY_ID = "hadm_id * 10 + CASE WHEN subject_id % 7 = 3 AND ts >= TIMESTAMP_NTZ '2024-01-24 00:00:00' THEN 2 ELSE 1 END"

H = "INTERVAL '1' HOUR"


@dataclass(frozen=True)
class Rows:
    """One output row per base row and entry of ``each`` whose condition holds; ``columns`` are common."""

    columns: dict[str, str]
    each: list[tuple[str, dict[str, str]]]


@dataclass(frozen=True)
class Grouped:
    """One output row per group of base rows."""

    keys: tuple[str, ...]
    columns: dict[str, str]


@dataclass(frozen=True)
class Dictionary:
    """A code dictionary."""

    names: tuple[str, ...]
    rows: list[tuple]


def _pick(index: str, *values: str) -> str:
    arms = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values[:-1]))
    return f"CASE {index} {arms} ELSE {values[-1]} END"


def _text(index: str, *values: str | None) -> str:
    return _pick(index, *["CAST(NULL AS VARCHAR(60))" if v is None else f"'{v}'" for v in values])


IDS = {"subject_id": "subject_id", "hadm_id": "hadm_id", "stay_id": "stay_id"}


def _chart(condition: str, itemid: str, valuenum: str = "CAST(NULL AS DOUBLE)", value: str = "CAST(NULL AS VARCHAR(60))",
           time: str = "CASE WHEN id % 3 = 0 THEN th + INTERVAL '30' MINUTE ELSE th END") -> tuple[str, dict[str, str]]:
    return condition, {"charttime": time, "itemid": itemid, "value": value, "valuenum": f"CAST({valuenum} AS DOUBLE)"}


def _lab(condition: str, itemid: str, valuenum: str) -> tuple[str, dict[str, str]]:
    return condition, {"itemid": itemid, "valuenum": f"CAST({valuenum} AS DOUBLE)"}


def _drip(condition: str, itemid: int, rate: str = "v / 10", unit: str = "'mcg/kg/min'") -> tuple[str, dict[str, str]]:
    return condition, {"itemid": str(itemid), "rate": f"CAST({rate} AS DOUBLE)", "rateuom": unit}


ITEMS = [
    (221906, "Norepinephrine", "Medications", "inputevents"),
    (221662, "Dopamine", "Medications", "inputevents"),
    (222315, "Vasopressin", "Medications", "inputevents"),
    (221653, "Dobutamine", "Medications", "inputevents"),
    (221289, "Epinephrine", "Medications", "inputevents"),
    (222168, "Propofol", "Medications", "inputevents"),
    (227210, "Propofol (Intubation)", "Medications", "inputevents"),
    (221668, "Midazolam (Versed)", "Medications", "inputevents"),
    (221385, "Lorazepam (Ativan)", "Medications", "inputevents"),
    (299005, "Olanzapine", "Medications", "inputevents"),
    (221712, "Ketamine", "Medications", "inputevents"),
    (299006, "Ketamine (ingredient)", "Ingredients", "inputevents"),
    (229420, "Dexmedetomidine", "Medications", "inputevents"),
    (221824, "Haloperidol", "Medications", "inputevents"),
    (229233, "Rocuronium", "Medications", "inputevents"),
    (221555, "Cisatracurium", "Medications", "inputevents"),
    (221794, "Furosemide (Lasix)", "Medications", "inputevents"),
    (227531, "Mannitol", "Medications", "inputevents"),
    (225168, "Packed Red Blood Cells", "Blood Products/Colloids", "inputevents"),
    (220970, "Fresh Frozen Plasma", "Blood Products/Colloids", "inputevents"),
    (225158, "NaCl 0.9%", "Fluids/Intake", "inputevents"),
    (225802, "Dialysis - CRRT", "Dialysis", "procedureevents"),
    (225955, "Dialysis - SCUF", "Dialysis", "procedureevents"),
    (299001, "Sevoflurane", "Procedures", "procedureevents"),
    (299002, "Isoflurane, inhaled", "Procedures", "procedureevents"),
    (225752, "Arterial Line", "Access Lines", "procedureevents"),
]

DIAGNOSES = [
    ("51881", 9, "Acute respiratory failure"), ("J9601", 10, "Acute respiratory failure with hypoxia"),
    ("J441", 10, "Chronic obstructive pulmonary disease with exacerbation"), ("J80", 10, "Acute respiratory distress syndrome"),
    ("78552", 9, "Septic shock"), ("R6521", 10, "Severe sepsis with septic shock"), ("A419", 10, "Sepsis, shock not specified"),
    ("T8112XA", 10, "Postprocedural septic shock, initial encounter"), ("R570", 10, "Cardiogenic shock"),
    ("41071", 9, "Subendocardial infarction"), ("I214", 10, "Non-ST elevation myocardial infarction"),
    ("I252", 10, "Old myocardial infarction"), ("4280", 9, "Congestive heart failure, unspecified"),
    ("42541", 9, "Cardiomyopathy"), ("I110", 10, "Hypertensive heart disease with heart failure"),
    ("44100", 9, "Dissection of aorta"), ("4435", 9, "Peripheral vascular disease"), ("V434", 9, "Blood vessel replacement"),
    ("43491", 9, "Cerebral artery occlusion with cerebral infarction"), ("I639", 10, "Cerebral infarction, unspecified"),
    ("H3401", 10, "Transient retinal artery occlusion"), ("2900", 9, "Senile dementia"), ("G309", 10, "Alzheimer disease"),
    ("49121", 9, "Obstructive chronic bronchitis"), ("5064", 9, "Chronic respiratory conditions due to fumes"),
    ("7140", 9, "Rheumatoid arthritis"), ("M315", 10, "Giant cell arteritis"), ("53140", 9, "Gastric ulcer with hemorrhage"),
    ("K254", 10, "Gastric ulcer with hemorrhage"), ("07032", 9, "Chronic hepatitis B"), ("5715", 9, "Cirrhosis of liver"),
    ("K7030", 10, "Alcoholic cirrhosis"), ("25000", 9, "Diabetes mellitus"), ("E1165", 10, "Type 2 diabetes with hyperglycemia"),
    ("25040", 9, "Diabetes with renal manifestations"), ("E1121", 10, "Type 2 diabetes with nephropathy"),
    ("34290", 9, "Hemiplegia"), ("G8190", 10, "Hemiplegia, unspecified"), ("5856", 9, "End stage renal disease"),
    ("N186", 10, "End stage renal disease"), ("Z992", 10, "Dependence on dialysis"), ("1629", 9, "Lung cancer"),
    ("C3490", 10, "Malignant neoplasm of bronchus"), ("20300", 9, "Multiple myeloma"), ("20302", 9, "Multiple myeloma, relapse"),
    ("C9000", 10, "Multiple myeloma"), ("4560", 9, "Esophageal varices with bleeding"), ("K7210", 10, "Chronic hepatic failure"),
    ("1970", 9, "Secondary malignancy of lung"), ("C7800", 10, "Secondary malignancy of lung"), ("C800", 10, "Disseminated neoplasm"),
    ("042", 9, "HIV disease"), ("B20", 10, "HIV disease"), ("20979", 9, "Secondary neuroendocrine tumor"),
    ("34982", 9, "Toxic encephalopathy, coma"), ("35801", 9, "Myasthenia gravis"), ("5849", 9, "Acute renal failure"),
    ("99811", 9, "Hemorrhage complicating a procedure"), ("Z4889", 10, "Encounter for postoperative care"),
    ("7802", 9, "Syncope"), ("Z9999", 10, None), ("V5861", 9, "Gaze turned towards the left"),
]
# same code under the other version: titles are looked up by code alone
TITLES = DIAGNOSES + [("5849", 10, "Cardiogenic shock of the other version"), ("042", 10, "Septic shock of the other version")]

DIAGNOSIS = _text(f"(CAST(floor(id / 10) AS BIGINT) * 7) % {len(DIAGNOSES)}", *[d[0] for d in DIAGNOSES])

SPECS: dict[str, Rows | Grouped | Dictionary] = {
    "patients": Grouped(("subject_id",), {
        "gender": "CASE WHEN subject_id % 2 = 0 THEN 'F' ELSE 'M' END",
        "anchor_age": "14 + (subject_id * 13) % 78",
        "anchor_year": "2023 + subject_id % 2",
        "dod": "CASE WHEN subject_id % 4 = 0 THEN CAST(max(th) + ((subject_id % 50) - 20) * INTERVAL '1' DAY AS DATE) END",
    }),
    "admissions": Grouped(("subject_id", "hadm_id"), {
        "admittime": "min(th) - INTERVAL '5' HOUR",
        "dischtime": "max(th) + INTERVAL '20' HOUR",
        "admission_type": _text("subject_id % 10", "EW EMER.", "EU OBSERVATION", "URGENT", "ELECTIVE",
                                "SURGICAL SAME DAY ADMISSION", "AMBULATORY OBSERVATION", "DIRECT EMER.", "ELECTIVE",
                                "OBSERVATION ADMIT", "NEWBORN"),
        "hospital_expire_flag": "CASE WHEN subject_id % 13 = 1 THEN NULL WHEN subject_id % 6 = 0 THEN 1 ELSE 0 END",
    }),
    "icustays": Grouped(("subject_id", "hadm_id", "stay_id"), {
        "intime": "min(th)", "outtime": "max(th) - INTERVAL '37' HOUR",
    }),
    "ventilation": Grouped(("stay_id",), {
        "ventilation_status": "CASE WHEN stay_id % 3 = 0 THEN 'InvasiveVent' ELSE 'NonInvasiveVent' END",
    }),
    # some rows without stay, some of another admission at the time of others
    "chartevents": Rows({**IDS, "hadm_id": "CASE WHEN id % 11 = 3 THEN hadm_id + 5 ELSE hadm_id END", "stay_id": "CASE WHEN id % 37 = 5 THEN NULL ELSE stay_id END"}, [
        _chart("v >= 0", "220045", "30 + v * 1.2"),
        _chart("v >= 0", _pick("id % 3", "220179", "220050", "225309"), "60 + v * 1.5"),
        _chart("id % 9 = 0", "220050", "60 + v * 1.5"),
        _chart("v >= 0", _pick("id % 3", "220180", "220051", "225310"), "30 + v * 0.8"),
        _chart("id % 4 <> 1", _pick("id % 3", "220052", "220181", "225312"), "40 + v"),
        _chart("id % 6 <> 1", _pick("id % 2", "220210", "224690"), "6 + v * 0.3 + CASE WHEN id % 17 = 0 THEN 60 ELSE 0 END"),
        _chart("id % 2 = 0", "223761", "92 + v * 0.1"),
        _chart("id % 3 = 0", "223762", "33 + v * 0.06"),
        _chart("id % 5 <> 2", "220277", "85 + v * 0.2"),
        _chart("id % 4 <> 0", "223901", "1 + id % 6"),
        _chart("id % 3 <> 0", "223900", "id % 6", "CASE WHEN id % 6 = 0 THEN 'No Response-ETT' ELSE 'Oriented' END"),
        _chart("id % 5 <> 0", "220739", "1 + id % 4"),
        _chart("id % 8 = 1", "224093", value=_text("id % 3", "Prone", "Supine", "Swimmers Position - L")),
        _chart("id % 2 = 0", "220224", "40 + v", time="th - INTERVAL '1' HOUR"),
        _chart("id % 5 = 1", "220224", "45 + v", time="th"),
        _chart("id % 3 = 0", "220235", "25 + v * 0.5", time="th - INTERVAL '2' HOUR"),
        _chart("id % 3 = 1", "220235", "26 + v * 0.5", time="th - INTERVAL '121' MINUTE"),
        _chart("id % 6 = 2", "226732", value=_text("id % 4", "CPAP mask ", "Nasal cannula", "Bipap mask ", "None")),
        _chart("id % 10 = 0", "223758", value="CASE WHEN subject_id % 12 = 5 THEN 'DNR / DNI' ELSE 'Full code' END"),
    ]),
    "labevents": Rows({"subject_id": "subject_id", "hadm_id": "hadm_id", "charttime": "th"}, [
        _lab("id % 2 = 0", "50820", "6.8 + v / 200"),
        _lab("id % 4 = 0", "50821", "35 + v"),
        _lab("id % 4 = 1", "50818", "20 + v * 0.5"),
        _lab("id % 3 <> 0", "50813", "v / 12"),
        _lab("v >= 0", "CASE WHEN id % 2 = 0 THEN 50811 ELSE 51222 END", "6 + v / 20"),
        _lab("id % 3 = 1", "50862", "1.5 + v / 15"),
        _lab("id % 4 <> 2", "51265", "10 + v * 3"),
        _lab("v >= 0", "CASE WHEN id % 2 = 0 THEN 51300 ELSE 51301 END", "v / 4"),
        _lab("id % 3 <> 2", "50885", "v / 15"),
        _lab("id % 5 <> 0", "50912", "v / 25"),
        _lab("id % 5 <> 1", "51006", "5 + v"),
        _lab("v >= 0", "CASE WHEN id % 3 = 0 THEN 50824 ELSE 50983 END", "118 + v * 0.4"),
        _lab("v >= 0", "CASE WHEN id % 3 = 0 THEN 50822 ELSE 50971 END", "2.2 + v / 30"),
        _lab("id % 6 <> 3", "50882", "10 + v / 5"),
        _lab("id % 7 = 0", "CASE WHEN id % 2 = 0 THEN 50810 ELSE 51221 END", "20 + v / 5"),
        _lab("id % 11 = 0", "51006", "9 + v"),
        _lab("id % 5 = 0", "50931", "v"),
    ]),
    "inputevents": Rows({
        **IDS, "starttime": "th", "endtime": f"th + (id % 9) * {H}", "amount": "v",
        "patientweight": "CAST(CASE WHEN id % 56 = 0 THEN 1 ELSE 60 + id % 40 END AS DOUBLE)", "linkorderid": "id",
    }, [
        _drip("id % 4 = 0", 221906, "v / 400", "CASE WHEN id % 28 = 0 THEN 'mg/kg/min' ELSE 'mcg/kg/min' END"),
        _drip("id % 12 = 0", 221906, "v / 380"),
        _drip("id % 9 = 1", 221662, "v / 5"),
        _drip("id % 7 = 2", 222315, "v / 20", "CASE WHEN id % 3 = 0 THEN 'units/min' ELSE 'units/hour' END"),
        _drip("id % 11 = 3", 221653, "v / 6"),
        _drip("id % 8 = 5", 221289, "v / 500"),
        _drip("id % 6 = 1", 222168), _drip("id % 15 = 2", 227210), _drip("id % 10 = 3", 221668),
        _drip("id % 20 = 4", 221385), _drip("id % 25 = 5", 299005), _drip("id % 14 = 6", 221712),
        _drip("id % 14 = 7", 299006), _drip("id % 9 = 8", 229420), _drip("id % 18 = 9", 221824),
        _drip("id % 12 = 10", 229233), _drip("id % 16 = 11", 221555), _drip("id % 9 = 0", 221794),
        _drip("id % 30 = 12", 227531), _drip("id % 13 = 0", 225168), _drip("id % 17 = 0", 220970),
        _drip("id % 2 = 0", 225158),
    ]),
    "outputevents": Rows({**IDS, "charttime": "th"}, [
        ("id % 2 = 0", {"itemid": "226559", "value": "v * 3"}),
        ("id % 3 = 0", {"itemid": "226560", "value": "v * 2"}),
        ("id % 5 = 0", {"itemid": "226557", "value": "v"}),
        ("id % 7 = 0", {"itemid": "227488", "value": "v * 9"}),
    ]),
    "procedureevents": Rows({**IDS, "starttime": "th", "endtime": f"CASE WHEN id % 4 <> 0 THEN th + (id % 40) * {H} END"}, [
        ("id % 5 = 0", {"itemid": "225802"}), ("id % 9 = 1", {"itemid": "225955"}), ("id % 10 = 4", {"itemid": "299001"}),
        ("id % 21 = 5", {"itemid": "299002"}), ("id % 3 = 0", {"itemid": "225752"}),
    ]),
    "prescriptions": Rows({
        "subject_id": "subject_id", "hadm_id": "hadm_id", "starttime": f"th - (id % 3) * 30 * {H}",
        "stoptime": f"CASE WHEN id % 10 <> 0 THEN th + (id % 50) * {H} END",
    }, [
        ("id % 4 = 0", {"drug": "'Fentanyl Citrate'"}), ("id % 9 = 2", {"drug": "'MORPHINE Sulfate'"}),
        ("id % 5 = 1", {"drug": "'Acetaminophen'"}), ("id % 6 = 3", {"drug": "'Dexamethasone'"}),
        ("id % 8 = 4", {"drug": "'Hydrocortisone Na Succ.'"}), ("id % 11 = 5", {"drug": "'MethylPREDNISolone Sodium Succ'"}),
    ]),
    "procedures_icd": Rows({"subject_id": "subject_id", "hadm_id": "hadm_id", "chartdate": "CAST(ts AS DATE)"}, [
        ("id % 9 = 0", {"icd_code": _text("id % 5", "0012", "3E0F7SD", "3E0F3SD", "5A1955Z", "0BH17EZ")}),
    ]),
    "diagnoses_icd": Rows({"hadm_id": "hadm_id", "seq_num": "1 + CAST(floor(id / 10) AS BIGINT) % 5"}, [
        ("id % 10 = 0", {
            "icd_code": f"CASE WHEN id % 70 = 0 THEN lower({DIAGNOSIS}) ELSE {DIAGNOSIS} END",
            "icd_version": _pick(f"(CAST(floor(id / 10) AS BIGINT) * 7) % {len(DIAGNOSES)}", *[str(d[1]) for d in DIAGNOSES]),
        }),
    ]),
    "microbiologyevents": Rows({"hadm_id": "hadm_id", "chartdate": "CAST(ts AS DATE)"}, [
        ("id % 4 = 0", {
            "spec_type_desc": _text("id % 13", "SPUTUM", "URINE", "PERITONEAL FLUID", "SWAB", "CSF;SPINAL FLUID",
                                    "BLOOD CULTURE", None, "STOOL", "Mini-BAL", "BLOOD CULTURE (MYCO)", "TISSUE", "MRSA SCREEN", "EAR"),
            "org_name": _text("id % 5", "STAPHYLOCOCCUS AUREUS", "ESCHERICHIA COLI", None, "ENTEROCOCCUS FAECALIS", "YEAST"),
        }),
    ]),
    "services": Rows({"hadm_id": "hadm_id", "transfertime": "CASE WHEN id % 100 <> 0 THEN th END"}, [
        ("id % 20 = 0", {"curr_service": _text("id % 7", "MED", "CSURG", "SURG", "NMED", "TSURG", "CMED", "OMED")}),
    ]),
    "height": Rows({"stay_id": "stay_id", "charttime": "th"}, [("id % 9 = 0", {"height": "CAST(150 + id % 45 AS DOUBLE)"})]),
    "weight_durations": Rows({"stay_id": "stay_id", "starttime": "th"}, [
        ("id % 6 = 0", {"weight": "45 + v / 2", "weight_type": "CASE WHEN id % 4 = 0 THEN 'admit' ELSE 'daily' END"}),
    ]),
    "suspicion_of_infection": Rows({"subject_id": "subject_id", "hadm_id": "hadm_id"}, [
        ("id % 15 = 0", {"suspected_infection_time": f"CASE WHEN id % 45 <> 0 THEN th - (id % 4) * 10 * {H} END"}),
    ]),
    "oxygen_delivery": Rows({"stay_id": "stay_id", "charttime": "th"}, [
        ("id % 2 = 0", {"o2_delivery_device_1": _text(
            "(dd + subject_id) % 14", "Endotracheal tube", "Endotracheal tube", "Tracheostomy tube", "Trach mask ", "CPAP mask ",
            "Bipap mask ", "High flow nasal cannula", "Nasal cannula", "None", "Venti mask ", "Endotracheal tube", "Other", None, "Face tent")}),
    ]),
    "ventilator_setting": Rows({"subject_id": "subject_id", "stay_id": "stay_id", "charttime": "th"}, [
        ("id % 10 <> 9", {
            "ventilator_mode": _text("CAST(floor(dd / 2) + subject_id AS BIGINT) % 6", "CMV/ASSIST/AutoFlow", "PSV/SBT", "CPAP/PSV", None, "SPONT", "Standby"),
            "ventilator_mode_hamilton": _text("(dd + subject_id) % 7", "ASV", "DuoPaP", "NIV", None, None, None, None),
            "ventilator_type": _text("subject_id % 3", "Hamilton", "Drager", None),
            "tidal_volume_observed": "CASE WHEN id % 4 <> 0 THEN 300 + v * 8 END",
            "tidal_volume_set": "CASE WHEN id % 3 <> 0 THEN 400 + v END",
            "tidal_volume_spontaneous": "CASE WHEN id % 5 = 0 THEN 350 + v END",
            "peep": "CASE WHEN id % 7 <> 0 THEN CAST(5 + id % 10 AS DOUBLE) END",
            "fio2": "CASE WHEN id % 23 = 0 THEN NULL WHEN id % 29 = 0 THEN 0.0 ELSE CAST(21 + id % 80 AS DOUBLE) END",
        }),
    ]),
    "d_items": Dictionary(("itemid", "label", "category", "linksto"), ITEMS),
    "d_icd_diagnoses": Dictionary(("icd_code", "icd_version", "long_title"), TITLES),
}

_ORACLE_TYPES = {"long": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP",
                 "date": "DATE"}


# tables that many stages read; a run over the whole pipeline writes them once
STORED = ("chartevents", "labevents", "inputevents")


def clinical_sources(spark: SparkSession, sf_dir: str, stored: tuple[str, ...] = ()) -> Sources:
    """Registry of the derived clinical tables; those in ``stored`` are written to the shared folder first."""
    events = Sources(spark, sf_dir).table("events")
    base = events.selectExpr(*[f"{sql} AS {name}" for name, sql in BASE]).selectExpr("*", f"{STAY_ID} AS stay_id")
    return Sources(spark, frames=_Derived(spark, base, stored))


class _Derived(dict):
    """Builds a frame only when it is asked for."""

    def __init__(self, spark: SparkSession, base: DataFrame, stored: tuple[str, ...]):
        super().__init__({name: _spark_table(spark, base, name) for name in SPECS})
        self.stored = stored

    def __getitem__(self, name: str) -> DataFrame:
        frame = super().__getitem__(name)()
        return materialize(frame, name) if name in self.stored else frame


def _spark_table(spark: SparkSession, base: DataFrame, name: str):
    spec = SPECS[name]
    if isinstance(spec, Dictionary):
        return lambda: spark.sql(_values(spec))
    if isinstance(spec, Grouped):
        return lambda: base.groupBy(*spec.keys).agg(*[F.expr(_spark(f"{sql} AS {c}")) for c, sql in spec.columns.items()])
    each = [
        f"CASE WHEN {condition} THEN named_struct({', '.join(f'{chr(39)}{c}{chr(39)}, {_typed(name, c, sql, spark=True)}' for c, sql in row.items())}) END"
        for condition, row in spec.each
    ]
    common = [f"{sql} AS {c}" for c, sql in spec.columns.items()]
    return lambda: (
        base.selectExpr(*[_spark(c) for c in common], _spark(f"explode(array({', '.join(each)})) AS _row"))
        .filter("_row IS NOT NULL")
        .selectExpr(*spec.columns, "_row.*")
    )


def _values(spec: Dictionary) -> str:
    """A dictionary as an inline table."""
    rows = ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in spec.rows)
    return f"SELECT * FROM (VALUES {rows}) AS t({', '.join(spec.names)})"


def _spark(sql: str) -> str:
    return sql.replace("VARCHAR(60)", "STRING")


def _typed(table: str, column: str, sql: str, spark: bool) -> str:
    kind = column_types(table)[column]
    return f"CAST({sql} AS {kind if spark else _ORACLE_TYPES[kind]})"


def oracle_tables() -> dict[str, str]:
    """The same tables as SQL for the oracle, by name."""
    base = ", ".join(f"{sql} AS {name}" for name, sql in BASE)
    out = {"base": f"SELECT *, {STAY_ID} AS stay_id FROM (SELECT {base} FROM events)"}
    for name, spec in SPECS.items():
        if isinstance(spec, Dictionary):
            out[name] = _values(spec)
        elif isinstance(spec, Grouped):
            columns = [f"{k}" for k in spec.keys] + [f"{_typed(name, c, sql, spark=False)} AS {c}" for c, sql in spec.columns.items()]
            out[name] = f"SELECT {', '.join(columns)} FROM base GROUP BY {', '.join(spec.keys)}"
        else:
            parts = []
            for condition, row in spec.each:
                columns = [f"{_typed(name, c, sql, spark=False)} AS {c}" for c, sql in {**spec.columns, **row}.items()]
                parts.append(f"SELECT {', '.join(columns)} FROM base WHERE {condition}")
            out[name] = " UNION ALL ".join(parts)
    return {name: sql.replace("TIMESTAMP_NTZ", "TIMESTAMP") for name, sql in out.items()}
