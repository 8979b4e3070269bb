"""The clinical pipeline: every stage as a DataFrame, from sources to the final analysis table.

Frames that several later stages read (the cohort, the ventilation episodes, the wide table) are written once to
the shared folder when a stage first needs them, and read back, see ``materialize``; ``close`` deletes them. All else
is lazy. Binned features stay keyed by ``(stay_id, bin_index)``: they are aggregated on that key, so joining them to
the spine adds no further exchange; what is known per stay is joined before the spine is made of it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame

from tidespan.functions.rounding import round_half_up
from tidespan.functions.scoring import safe_ratio
from tidespan.operators.outer import keep_groups
from tidespan.operators.skew import has_heavy
from tidespan.operators.spine import time_spine
from tidespan.plans import measurements, rules, severity, stays, treatments, ventilation
from tidespan.sources.registry import Sources, materialize, release, remove_table
from tidespan.sources.snapshots import write_snapshot

BIN = ["stay_id", "bin_index"]
KEYS = ["subject_id", "hadm_id", "stay_id", "icu_day_start"]
TREATMENT_FLAGS = ("prone_24h", "crrt_24h", "ino_24h", "diuretic_24h", "steroid_24h", "transfusion_24h")
# fixed values: names and order of the output columns, and the names of the stages below
STAY_FLAGS = ("infection_at_icu_admission", "site_of_infection", "admission_category", "ards", "septic_shock")
WIDE = (
    *stays.COHORT, "weight", "height", "bmi", "comorb_score", "icu_day_start", *measurements.LAB_COLUMNS, "uo",
    *sorted(measurements.RATE_COLUMNS), *TREATMENT_FLAGS, "transfusion_type", "neuroblock", "opioids", "is_sedated",
    "sedation_type", *STAY_FLAGS, "gcs", *measurements.VITAL_COLUMNS, "shock_index", *ventilation.PARAMETERS, "pao2fio2ratio",
)


@dataclass(frozen=True)
class Options:
    """Choices that default to the documented behaviour.

    ratio_numerator: blood gas in ``pao2fio2ratio`` (``paco2``, or ``pao2``); urine: aggregate of urine per
    bin (``avg`` or ``sum``); saps_hours: limit of the stay score (``None`` = whole stay);
    max_gap_hours: silence that ends a ventilation episode; one_row_per_bin: keep one episode per bin;
    rows_without_bin: report settings outside the stay in ``vent_param``.
    """

    ratio_numerator: str = "paco2"
    urine: str = "avg"
    saps_hours: int | None = None
    max_gap_hours: float | None = None
    one_row_per_bin: bool = False
    rows_without_bin: bool = True


class Pipeline:
    def __init__(self, sources: Sources, options: Options = Options()):
        self.t = sources
        self.options = options
        self._made: list[str] = []

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        kept = materialize(df, name, self._made)
        release(self.t.spark)
        return kept

    def _remove(self, name: str) -> None:
        """Delete a kept table that nothing reads any more."""
        path = next(p for p in self._made if p.rpartition("/")[2].startswith(f"{name}-"))
        self._made.remove(path)
        remove_table(self.t.spark, path)

    def close(self) -> None:
        """Delete the intermediate tables of this pipeline; frames that read them are of no use afterwards."""
        while self._made:
            remove_table(self.t.spark, self._made.pop())

    def __enter__(self) -> Pipeline:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    # --- stays -----------------------------------------------------------------------------------
    @cached_property
    def admitted_stays(self) -> DataFrame:
        return self._keep(stays.admitted_stays(self.t("patients"), self.t("admissions"), self.t("icustays")), "stays")

    def demographics(self) -> DataFrame:
        return stays.demographics(self.admitted_stays, self.t("chartevents"))

    def cohort(self) -> DataFrame:
        return stays.cohort(self.demographics())

    @cached_property
    def cohort_table(self) -> DataFrame:
        return self._keep(self.cohort(), "cohort")

    @property
    def stays(self) -> DataFrame:
        return stays.stay_windows(self.cohort_table)

    def bmi(self) -> DataFrame:
        return stays.body_size(self.stays, self.t("height"), self.t("weight_durations"))

    def charlson(self) -> DataFrame:
        return stays.comorbidity(self.cohort_table, self.t("diagnoses_icd"))

    def alldemocohort(self) -> DataFrame:
        return stays.all_demo_cohort(self.cohort_table, self.bmi(), self.charlson())

    def spine(self, of: DataFrame | None = None, known: DataFrame | None = None) -> DataFrame:
        """The bins of the stays, with the columns of ``known`` (one row a stay; stays without one have no bins)."""
        of = of if of is not None else self.stays
        if known is None:
            return time_spine(of, "icu_intime", "icu_outtime", name="icu_day_start", columns=KEYS[:3])
        more = [c for c in known.columns if c not in of.columns]
        stay = of.join(known.select("stay_id", *more), "stay_id")
        columns = list(dict.fromkeys([*KEYS[:3], *known.columns]))
        return time_spine(stay, "icu_intime", "icu_outtime", name="icu_day_start", columns=columns)

    @staticmethod
    def _rows_of(events: DataFrame, of: DataFrame | None, key: str) -> DataFrame:
        """Events of the given stays or patients alone, before they are pivoted."""
        return events if of is None else events.join(of.select(key), key, "left_semi")

    # --- measurements ----------------------------------------------------------------------------
    def vasopressors(self) -> DataFrame:
        return measurements.vasopressors(self.t("inputevents"))

    def geturineoutput(self) -> DataFrame:
        return measurements.urine_output(self.t("outputevents"))

    def getalllabvalues(self, of: DataFrame | None = None) -> DataFrame:
        every = self.t("labevents")
        heavy = of is None or has_heavy(measurements.counted_labs(every), ["subject_id"])
        return measurements.lab_values(self._rows_of(every, of, "subject_id"), self.t("chartevents"), every, heavy)

    def getallvitalsigns(self, of: DataFrame | None = None) -> DataFrame:
        every = self.t("chartevents")
        heavy = of is None or has_heavy(measurements.counted_vitals(every), ["stay_id"])
        return measurements.vital_signs(self._rows_of(every, of, "stay_id"), every, of is not None, heavy)

    def lab_bins(self, of: DataFrame, labs: DataFrame | None = None) -> DataFrame:
        return measurements.lab_bins(self.getalllabvalues(of) if labs is None else labs, of)

    def urine_bins(self, of: DataFrame) -> DataFrame:
        return measurements.urine_bins(self.geturineoutput(), of, self.options.urine)

    def vital_bins(self, of: DataFrame, vitals: DataFrame | None = None) -> DataFrame:
        return measurements.vital_bins(self.getallvitalsigns(of) if vitals is None else vitals, of)

    def vasopressor_bins(self, of: DataFrame) -> DataFrame:
        return measurements.vasopressor_bins(self.vasopressors(), of)

    def _every_bin(self, features: DataFrame, flags: tuple[str, ...] = (), known: DataFrame | None = None) -> DataFrame:
        """All bins of all stays; flags without event become 0."""
        columns = [c for c in features.columns if c not in BIN]
        more = [c for c in known.columns if c not in KEYS] if known is not None else []
        return self.spine(known=known).join(features, BIN, "left").selectExpr(
            *KEYS, *more, *[f"coalesce({c}, 0) AS {c}" if c in flags else c for c in columns])

    def getalllabvalues_time(self) -> DataFrame:
        return self._every_bin(self.lab_bins(self.stays))

    def geturineoutput_time(self) -> DataFrame:
        return self._every_bin(self.urine_bins(self.stays))

    def getallvitalsigns_time(self) -> DataFrame:
        return self._every_bin(self.vital_bins(self.stays))

    def getvasopressor_time(self) -> DataFrame:
        return self._every_bin(self.vasopressor_bins(self.stays))

    # --- treatments ------------------------------------------------------------------------------
    def infection(self) -> DataFrame:
        return treatments.infection(self.stays, self.t("suspicion_of_infection"), self.t("microbiologyevents"))

    def ards_shock_admission(self) -> DataFrame:
        return treatments.admission_reason(self.cohort_table, self.t("diagnoses_icd"), self.t("d_icd_diagnoses"))

    def sedative_bins(self, of: DataFrame) -> DataFrame:
        events = treatments.sedative_events(self.t("inputevents"), self.t("procedureevents"), self.t("d_items"))
        return treatments.sedative_bins(events, of)

    def opioid_bins(self, of: DataFrame, heavy: bool = True) -> DataFrame:
        return treatments.opioid_bins(self.t("prescriptions"), of, heavy)

    def neuroblock_bins(self, of: DataFrame) -> DataFrame:
        return treatments.neuroblock_bins(self.t("inputevents"), self.t("d_items"), of)

    def lookback_bins(self, of: DataFrame) -> DataFrame:
        events = treatments.lookback_events(self.t("inputevents"), self.t("procedureevents"), self.t("procedures_icd"),
                                            self.t("chartevents"), self.t("prescriptions"), self.t("d_items"))
        return treatments.lookback_flag_bins(events, of)

    def transfusion_types(self, of: DataFrame) -> DataFrame:
        return treatments.transfusion_types(self.t("inputevents"), self.t("d_items"), of)

    def sedatives(self) -> DataFrame:
        return self._every_bin(self.sedative_bins(self.stays), ("is_sedated",))

    def opioids(self) -> DataFrame:
        return self._every_bin(self.opioid_bins(self.stays), ("opioids",))

    def neuroblock(self) -> DataFrame:
        return self._every_bin(self.neuroblock_bins(self.stays), ("neuroblock",))

    def flags(self) -> DataFrame:
        types = self.stays.select("stay_id").join(self.transfusion_types(self.stays), "stay_id", "left")
        flags = self._every_bin(self.lookback_bins(self.stays), rules.LOOKBACK_FLAGS, types)
        return flags.select(*KEYS, *rules.LOOKBACK_FLAGS, "transfusion_type")

    def _treated_bins(self, spine: DataFrame, of: DataFrame, treated: DataFrame | None = None, heavy: bool = True) -> DataFrame:
        """Spine with all treatment flags of the bins.

        ``treated``: the flags of each bin, if they are written already; ``heavy``: whether an admission may be heavy in opioid prescriptions.
        """
        features = [treated] if treated is not None else [
            self.lookback_bins(of), self.neuroblock_bins(of), self.opioid_bins(of, heavy), self.sedative_bins(of)]
        flags = (*rules.LOOKBACK_FLAGS, "neuroblock", "opioids", "is_sedated")
        rows = reduce(lambda left, right: left.join(right, BIN, "left"), features, spine)
        return rows.selectExpr(*[f"coalesce({c}, 0) AS {c}" if c in flags else c for c in rows.columns])

    def _stay_flags(self, of: DataFrame) -> DataFrame:
        """What is known per stay, in one frame, so that the bins are joined with it only once."""
        flags = self.infection().drop("icu_intime").join(self.ards_shock_admission(), KEYS[:2])
        return flags.join(self.transfusion_types(of), "stay_id", "left")

    def allflags(self) -> DataFrame:
        return self._treated_bins(self.spine(known=self._stay_flags(self.stays)), self.stays).select(
            *KEYS, *rules.LOOKBACK_FLAGS, "transfusion_type", "neuroblock", "opioids", "is_sedated", "sedation_type", *STAY_FLAGS)

    # --- ventilation -----------------------------------------------------------------------------
    def vent_time(self, heavy: bool = True) -> DataFrame:
        return ventilation.ventilation_episodes(self.stays, self.t("ventilator_setting"), self.t("oxygen_delivery"),
                                                self.options.max_gap_hours, heavy)

    @cached_property
    def vent_time_table(self) -> DataFrame:
        return self._keep(self.vent_time(has_heavy(self.t("ventilator_setting"), ["stay_id"])), "vent_time")

    @cached_property
    def ventilated_stays(self) -> DataFrame:
        """Read by every feature of the wide table, so it is written once."""
        return self._keep(ventilation.ventilated(self.stays, self.vent_time_table), "ventilated_stays")

    def _vent_param(self, outside: bool) -> DataFrame:
        of, settings = self.ventilated_stays, self.t("ventilator_setting")
        extra = ventilation.settings_outside(settings, of) if outside else None
        return ventilation.vent_param(self.spine(of), ventilation.ventilator_bins(settings, of), extra)

    def vent_param(self) -> DataFrame:
        return self._vent_param(self.options.rows_without_bin).drop("bin_index")

    def prova_intubation(self) -> DataFrame:
        return self._intubation(self.options.rows_without_bin)

    def _intubation(self, outside: bool, heavy: bool = True) -> DataFrame:
        return ventilation.intubation(self._vent_param(outside), self.vent_time_table, self.ventilated_stays,
                                      self.options.one_row_per_bin, heavy)

    # --- wide tables and scores ------------------------------------------------------------------
    def overalltable1(self) -> DataFrame:
        """All features of every bin of the ventilated stays (73 columns)."""
        return self._wide()

    def _treated(self, of: DataFrame) -> DataFrame:
        """The treatment flags of every bin, each bin once."""
        heavy = has_heavy(treatments.opioid_prescriptions(self.t("prescriptions")), treatments.ADMISSION_KEYS)
        return self._treated_bins(self.spine(of).select(*BIN).distinct(), of, heavy=heavy)

    def _wide(self, labs: DataFrame | None = None, vitals: DataFrame | None = None, treated: DataFrame | None = None) -> DataFrame:
        """``overalltable1``, of laboratory values, vital signs and treatment flags that are written already if given."""
        of = self.ventilated_stays
        features = [
            self.lab_bins(of, labs), self.urine_bins(of), self.vasopressor_bins(of), self.vital_bins(of, vitals),
            ventilation.ventilator_bins(self.t("ventilator_setting"), of),
        ]
        stay = self._keep(self._keep(self.alldemocohort(), "alldemocohort").join(self._stay_flags(of), KEYS[:3]), "stay_columns")
        rows = reduce(lambda left, right: left.join(right, BIN, "left"), features, self._treated_bins(self.spine(of, stay), of, treated))
        return rows.selectExpr(
            "*", f"{round_half_up(safe_ratio('heartrate', 'sysbp'))} AS shock_index",
            f"{safe_ratio(self.options.ratio_numerator, 'fio2', 100.0)} AS pao2fio2ratio",
        ).select(*WIDE)

    @cached_property
    def wide_table(self) -> DataFrame:
        """Laboratory values, vital signs and treatment flags are written first: one plan for all is too much for a small driver.

        They are cut where their rows are exchanged anyway, or are a few flags.
        """
        of = self.ventilated_stays
        parts = [self._keep(df(of), name) for name, df in (
            ("labs", self.getalllabvalues), ("vitals", self.getallvitalsigns), ("treated", self._treated))]
        wide = self._keep(self._wide(*parts), "overalltable1")
        for name in ("labs", "vitals", "treated"):
            self._remove(name)
        return wide

    def sapsii(self) -> DataFrame:
        return severity.saps(self.wide_table, self.t("icustays"), self.t("admissions"), self.t("services"),
                             self.t("diagnoses_icd"), self.t("ventilation"), self.t("chartevents"), self.options.saps_hours)

    def sofadays(self) -> DataFrame:
        return severity.sofa_days(self.wide_table)

    @cached_property
    def scored_bins(self) -> DataFrame:
        """What ``overalltable2`` adds to the bins: intubation, daily and stay scores, without the wide columns; and the highest pH of the day.

        The joins are made on these few columns, so that the wide rows pass through one join only.
        """
        tube = self._intubation(False, has_heavy(self.vent_time_table, ["stay_id"])).drop(*ventilation.PARAMETERS)
        sofa = severity.sofa_days(self.wide_table, ["max(ph) AS day_ph"]).selectExpr(
            *KEYS[:3], "icu_day_start AS day", "cast(sofa AS double) AS sofa",
            "percentual_missing_value AS percentual_missing_value_sofa", "day_ph")
        saps = self.sapsii().selectExpr(
            *KEYS[:3], "sapsii", "percent_missing_value_sapsii AS percentual_missing_value_sapsii")
        days = self._keep(sofa.join(saps, KEYS[:3], "left"), "scored_days")
        rows = tube.selectExpr("*", "cast(icu_day_start AS date) AS day").join(days, ["subject_id", "stay_id", "day"]).drop("day")
        return self._keep(rows, "scored_bins")

    def _scored(self, bins: DataFrame) -> DataFrame:
        """The wide rows of the given scored bins."""
        return self.wide_table.join(bins, KEYS).select(
            *WIDE, "is_intubated", "intubation_time", "extubation_time", *ventilation.EPISODE_COLUMNS, "sofa",
            "percentual_missing_value_sofa", "sapsii", "percentual_missing_value_sapsii")

    def overalltable2(self) -> DataFrame:
        """The wide table with intubation, daily and stay scores (85 columns)."""
        return self._scored(self.scored_bins)

    @cached_property
    def overalltable2_table(self) -> DataFrame:
        return self._keep(self.overalltable2(), "overalltable2")

    def final_data(self) -> DataFrame:
        """Rows of patients who were intubated at least once and have a pH value.

        The patients are picked among the scored bins, before these meet the wide rows: every wide row has scored bins, so
        the pH of their days is that of the wide rows.
        """
        kept = keep_groups(self.scored_bins, "subject_id", "_tube > 0 AND _ph IS NOT NULL",
                           ["max(is_intubated) AS _tube", "max(day_ph) AS _ph"])
        return self._scored(kept)

    # --- sink ------------------------------------------------------------------------------------
    def write(self, folder: str, stages: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
        """Full refresh of the named stages (default all) as tables below ``folder``, each published as a whole.

        A stage that others read is written first, and they read the written table.
        """
        kept = {"cohort": "cohort_table", "vent_time": "vent_time_table", "overalltable1": "wide_table", "overalltable2": "overalltable2_table"}
        wanted = stages or STAGES
        out = {}
        for name in sorted(wanted, key=lambda n: (n not in kept, STAGES.index(n))):
            out[name] = write_snapshot(getattr(self, name)(), f"{folder}/{name}")
            if name in kept:
                self.__dict__.setdefault(kept[name], out[name])
        return {name: out[name] for name in wanted}


STAGES = (
    "demographics", "cohort", "bmi", "charlson", "vasopressors", "geturineoutput", "getalllabvalues", "getallvitalsigns",
    "infection", "sedatives", "opioids", "neuroblock", "flags", "ards_shock_admission", "allflags", "getalllabvalues_time",
    "geturineoutput_time", "getallvitalsigns_time", "getvasopressor_time", "alldemocohort", "vent_time", "vent_param",
    "overalltable1", "sapsii", "sofadays", "prova_intubation", "overalltable2", "final_data",
)
