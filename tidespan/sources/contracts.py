"""Schema contracts: the columns each source must offer, with their types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source tables and columns the feature pipeline reads.
CLINICAL = {
    "patients": "subject_id long, gender string, anchor_age int, anchor_year int, dod date",
    "admissions": "subject_id long, hadm_id long, admittime timestamp_ntz, dischtime timestamp_ntz, "
                  "admission_type string, hospital_expire_flag int",
    "icustays": "subject_id long, hadm_id long, stay_id long, intime timestamp_ntz, outtime timestamp_ntz",
    "chartevents": "subject_id long, hadm_id long, stay_id long, charttime timestamp_ntz, itemid int, "
                   "value string, valuenum double",
    "labevents": "subject_id long, hadm_id long, charttime timestamp_ntz, itemid int, valuenum double",
    "inputevents": "subject_id long, hadm_id long, stay_id long, starttime timestamp_ntz, endtime timestamp_ntz, "
                   "itemid int, rate double, rateuom string, amount double, patientweight double, linkorderid long",
    "outputevents": "subject_id long, hadm_id long, stay_id long, charttime timestamp_ntz, itemid int, value double",
    "procedureevents": "subject_id long, hadm_id long, stay_id long, starttime timestamp_ntz, "
                       "endtime timestamp_ntz, itemid int",
    "d_items": "itemid int, label string, category string, linksto string",
    "prescriptions": "subject_id long, hadm_id long, drug string, starttime timestamp_ntz, stoptime timestamp_ntz",
    "procedures_icd": "subject_id long, hadm_id long, icd_code string, chartdate date",
    "diagnoses_icd": "hadm_id long, seq_num int, icd_code string, icd_version int",
    "d_icd_diagnoses": "icd_code string, icd_version int, long_title string",
    "microbiologyevents": "hadm_id long, chartdate date, spec_type_desc string, org_name string",
    "services": "hadm_id long, transfertime timestamp_ntz, curr_service string",
    "height": "stay_id long, charttime timestamp_ntz, height double",
    "weight_durations": "stay_id long, starttime timestamp_ntz, weight double, weight_type string",
    "suspicion_of_infection": "subject_id long, hadm_id long, suspected_infection_time timestamp_ntz",
    "oxygen_delivery": "stay_id long, charttime timestamp_ntz, o2_delivery_device_1 string",
    "ventilator_setting": "subject_id long, stay_id long, charttime timestamp_ntz, ventilator_mode string, "
                          "ventilator_mode_hamilton string, ventilator_type string, tidal_volume_observed double, "
                          "tidal_volume_set double, tidal_volume_spontaneous double, peep double, fio2 double",
    "ventilation": "stay_id long, ventilation_status string",
}


def column_types(table: str) -> dict[str, str]:
    """Column names and type names of a contract; needs no session."""
    return dict(column.split() for column in CLINICAL[table].split(","))


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select exactly the contract's columns; a missing column or a type that cannot be cast is an error."""
    missing = [f.name for f in struct(CLINICAL[table]) if f.name not in df.columns]
    if missing:
        raise ValueError(f"table {table} lacks {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in struct(CLINICAL[table])])
