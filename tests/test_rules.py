"""A sample of the rule values, written down a second time by hand: the oracle reads the same tables as the engine."""

from tidespan.plans import rules


def codes(table, flag, version, length):
    return {c for r in table[flag] if (r.version, r.length) == (version, length) for c in r.members}


def test_comorbidity_codes():
    assert codes(rules.CHARLSON, "myocardial_infarct", 9, 3) == {"410", "412"}
    assert codes(rules.CHARLSON, "myocardial_infarct", 10, 3) == {"I21", "I22"}
    assert codes(rules.CHARLSON, "dementia", 10, 3) == {"F00", "F01", "F02", "F03", "G30"}
    assert codes(rules.CHARLSON, "diabetes_with_cc", 9, 4) == {"2504", "2505", "2506", "2507"}
    assert codes(rules.CHARLSON, "rheumatic_disease", 9, 4) == {"4465", "7100", "7101", "7102", "7103", "7104", "7140", "7141", "7142", "7148"}
    assert [(r.version, r.length, r.ranges) for r in rules.CHARLSON["chronic_pulmonary_disease"] if r.ranges] == [
        (9, 3, (("490", "505"),)), (10, 3, (("J40", "J47"), ("J60", "J67")))]
    assert len(rules.CHARLSON) == 17


def test_measured_ranges():
    limits = {m.name: (m.codes, m.low, m.high) for m in rules.LABS}
    assert limits["lactate"] == ((50813,), 0, 50) and limits["platelet"] == ((51265,), 0, 10000) and limits["ph"][0] == (50820,)
    assert {m.codes for m in rules.VITALS if m.name == "sysbp"} == {(220179, 220050, 225309)}
    assert rules.GCS_ITEMS == {"motor": 223901, "verbal": 223900, "eyes": 220739}
    assert rules.VASOPRESSORS["norepinephrine"] == 221906 and rules.VASOPRESSORS["vasopressin"] == 222315


def test_admission_codes_and_points():
    assert {(r.version, r.members) for r in rules.ADMISSION_CODES["septic_shock"]} == {(9, ("78552",)), (10, ("T8112",)), (10, ("R6521",))}
    assert {(r.version, r.members) for r in rules.ADMISSION_CODES["ards"]} == {(9, ("51882", "51881")), (10, ("J80",))}
    assert rules.RESPIRATION_POINTS == [("<", 100, 4), ("<", 200, 3), ("<", 300, 2), ("<", 400, 1)]
    assert rules.COAGULATION_POINTS == [("<", 20, 4), ("<", 50, 3), ("<", 100, 2), ("<", 150, 1)]
    assert rules.MAX_TIDAL_VOLUME == 1500 and set(rules.CRRT_ITEMS) == {225802, 225955, 225809, 225803}
