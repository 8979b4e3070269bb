"""Clinical rule tables: codes, limits, drug names, labels and score points.

All values in this file are fixed values: results are only right with exactly these codes and limits.
"""

from __future__ import annotations

from tidespan.operators.codes import CodeRule
from tidespan.operators.pivot import Measure

# --- stays ---------------------------------------------------------------------------------------
ADMISSION_TYPES = [
    ("postSurgical ", ("EW EMER.", "EU OBSERVATION", "URGENT", "AMBULATORY OBSERVATION", "DIRECT OBSERVATION",
                       "OBSERVATION ADMIT", "DIRECT EMER.")),
    ("intensiveCare", ("ELECTIVE", "SURGICAL SAME DAY ADMISSION")),
]
DNR_TEXT = "%DNR%"

# --- laboratory ----------------------------------------------------------------------------------
LABS = (
    Measure("ph", (50820,)),
    Measure("paco2", (50818,)),
    Measure("pao2", (50821,)),
    Measure("lactate", (50813,), 0, 50),
    Measure("hemoglobin", (50811, 51222), 0, 50),
    Measure("albumin", (50862,), 0, 10),
    Measure("platelet", (51265,), 0, 10000),
    Measure("wbc", (51300, 51301), 0, 1000),
    Measure("bilirubin", (50885,), 0, 150),
    Measure("creatinine", (50912,), 0, 150),
    Measure("bun", (51006,), 0, 300),
    Measure("sodium", (50824, 50983), 0, 200),
    Measure("potassium", (50822, 50971), 0, 30),
    Measure("bicarbonate", (50882,), 0, 10000),
)
# read (such a row makes a time point) but not reported
HEMATOCRIT = Measure("hematocrit", (50810, 51221), 0, 100)
CHARTED_PO2 = 220224
CHARTED_PCO2 = 220235
BLOOD_GAS_TOLERANCE_HOURS = 2

# --- vital signs ---------------------------------------------------------------------------------
VITALS = (
    Measure("heartrate", (220045,), 0, 300),
    Measure("sysbp", (220179, 220050, 225309), 0, 400),
    Measure("diasbp", (220180, 220051, 225310), 0, 300),
    Measure("meanbp", (220052, 220181, 225312), 0, 300),
    Measure("resprate", (220210, 224690), 0, 70),
    Measure("tempc", (223761,), 70, 120, convert="({v} - 32) / 1.8D"),
    Measure("tempc", (223762,), 10, 50),
    Measure("spo2", (220277,), 0, 100, closed_high=True),
)
GCS_ITEMS = {"motor": 223901, "verbal": 223900, "eyes": 220739}
GCS_NORMAL = {"motor": 6, "verbal": 5, "eyes": 4}
GCS_LIMIT_HOURS = 6
TUBE_ANSWER = "No Response-ETT"

# --- infusions and urine -------------------------------------------------------------------------
VASOPRESSORS = {
    "norepinephrine": 221906,
    "dopamine": 221662,
    "vasopressin": 222315,
    "dobutamine": 221653,
    "epinephrine": 221289,
}
URINE_ITEMS = (226559, 226560, 226561, 226584, 226563, 226564, 226565, 226567, 226557, 226558)

# --- infection -----------------------------------------------------------------------------------
INFECTION_SITES = [
    ("Polmone", ("bronchial brush", "bronchial washings", "bronchoalveolar lavage", "mini-bal", "pleural fluid", "sputum",
                 "rapid respiratory viral screen & culture", "influenza a/b by dfa")),
    ("Vie urinarie", ("urine",)),
    ("Addome", ("peritoneal fluid",)),
    ("Tessuti molli", ("abscess", "ear", "foot culture", "foreign body", "staph aureus swab", "swab", "tissue")),
    ("Sistema nervoso centrale", ("csf;spinal fluid",)),
]
ENDOCARDITIS_SITE = "Endocardite sospetta"
ENDOCARDITIS_ORGANISMS = ("staphylococcus aureus", "enterococcus faecalis", "streptococcus viridans",
                          "staphylococcus epidermidis", "streptococcus sanguinis")
UNKNOWN_SITE = "Sconosciuto"
OTHER = "Altro"

# --- drugs ---------------------------------------------------------------------------------------
BENZODIAZEPINES = (
    "alprazolam", "bromazepam", "brotizolam", "chlordiazepoxide", "cinolazepam", "clobazam", "clonazepam", "clotiazepam",
    "diazepam", "estazolam", "flurazepam", "halazepam", "lorazepam", "lormetazepam", "medazepam", "midazolam",
    "nitrazepam", "nordazepam", "oxazepam", "prazepam", "quazepam", "temazepam", "triazolam",
)
NEUROLEPTICS = (
    "chlorpromazine", "levomepromazine", "perphenazine", "prochlorperazine", "thioridazine", "trifluoperazine",
    "droperidol", "pimozide", "zuclopenthixol", "flupentixol", "clotiapine", "loxapine", "amisulpride", "aripiprazole",
    "asenapine", "brexpiprazole", "cariprazine", "clozapine", "iloperidone", "lurasidone", "olanzapine", "paliperidone",
    "quetiapine", "risperidone", "sertindole", "ziprasidone",
)
HALOGENATED = ("desflurane", "enflurane", "halothane", "isoflurane", "methoxyflurane", "sevoflurane")
OPIOIDS = ("fentanyl", "morphine", "hydromorphone", "oxycodone", "pethidine", "meperidine", "codeine", "buprenorphine",
           "tramadol")
NEUROBLOCKERS = ("rocuronium", "vecuronium", "cisatracurium", "pancuronium", "atracurium", "succinylcholine")
DIURETICS = ("furosemide", "bumetanide", "ethacrynic acid", "piretanide", "chlorothiazide", "hydrochlorothiazide",
             "chlorthalidone", "metolazone", "quinethazone", "acetazolamide", "diclofenamide", "spironolactone",
             "triamterene", "amiloride", "mannitol")
STEROIDS = ("hydrocortisone", "methylprednisolone", "prednisolone", "dexamethasone")

# --- treatments of the last day ------------------------------------------------------------------
CRRT_ITEMS = (225802, 225955, 225809, 225803)
NITRIC_OXIDE_CODES = ("0012", "3E0F7SD", "3E0F8SD", "3E0F3SD")
PRONE_ITEM = 224093
PRONE_VALUES = ("Prone", "Swimmers Position - L", "Swimmers Position - R")
BLOOD_CATEGORY = "Blood Products/Colloids"
LOOKBACK_FLAGS = ("crrt_24h", "ino_24h", "diuretic_24h", "prone_24h", "steroid_24h", "transfusion_24h")

# --- reason for admission ------------------------------------------------------------------------
SEPTIC_CATEGORY = "Shock settico"
ADMISSION_CATEGORIES = [
    ("Insufficienza respiratoria acuta", ["acute respiratory failure", "pulmonary edema", "ARDS"]),
    ("Insufficienza respiratoria cronica riacutizzata (BPCO)",
     ["COPD with exacerbation", "chronic respiratory failure", "chronic obstructive pulmonary disease"]),
    ("Insufficienza neurologica centrale",
     ["meningitis", "encephalitis", "overdose", "cerebral infarction", "coma", "hypoxic encephalopathy"]),
    ("Insufficienza neurologica periferica", ["guillain-barre", "myasthenia gravis", "botulism", "tetanus"]),
    ("Scompenso metabolico", ["hyperglycemia", "ketoacidosis", "acute renal failure", "hepatic failure"]),
    ("Shock cardiogeno", ["cardiogenic shock", "acute heart failure"]),
    (SEPTIC_CATEGORY, ["septic shock", ("sepsis", "shock")]),
    ("Shock emorragico/ipovolemico", ["hypovolemic shock", "hemorrhage", "bleeding"]),
    ("Monitoraggio postoperatorio", ["postoperative", "following surgery", "post op"]),
]
ADMISSION_CODES = {
    "septic_shock": [CodeRule(9, None, ("78552",)), CodeRule(10, 5, ("T8112",), any_case=True), CodeRule(10, None, ("R6521",), any_case=True)],
    "ards": [CodeRule(9, None, ("51882", "51881")), CodeRule(10, 3, ("J80",), any_case=True)],
}

# --- ventilation ---------------------------------------------------------------------------------
TUBES = ("Endotracheal tube", "Tracheostomy tube")
TRACHEOSTOMY_DEVICES = ("Tracheostomy tube", "Trach mask ")
INVASIVE_MODES = (
    "(S) CMV", "APRV", "APRV/Biphasic+ApnPress", "APRV/Biphasic+ApnVol", "APV (cmv)", "Apnea Ventilation", "CMV",
    "CMV/ASSIST", "CMV/ASSIST/AutoFlow", "CMV/AutoFlow", "MMV", "MMV/AutoFlow", "MMV/PSV", "MMV/PSV/AutoFlow", "P-CMV",
    "PCV+", "PCV+/PSV", "PCV+Assist", "PRES/AC", "PRVC/AC", "PRVC/SIMV", "PSV/SBT", "SIMV", "SIMV/AutoFlow",
    "SIMV/PRES", "SIMV/PSV", "SIMV/PSV/AutoFlow", "SIMV/VOL", "SYNCHRON MASTER", "SYNCHRON SLAVE", "VOL/AC",
)
PRESSURE_SUPPORT_MODES = ("CPAP/PPS", "CPAP/PSV", "CPAP/PSV+Apn TCPL", "CPAP/PSV+ApnPres", "CPAP/PSV+ApnVol")
TUBE_ONLY_MODES = (*PRESSURE_SUPPORT_MODES, "SPONT")
HAMILTON_INVASIVE_MODES = ("APRV", "APV (cmv)", "(S) CMV", "P-CMV", "SIMV", "APV (simv)", "P-SIMV", "VS", "ASV", "SPONT")
HAMILTON_DUAL_MODE = "DuoPaP"
HAMILTON_NONINVASIVE_MODES = ("DuoPaP", "NIV", "NIV-ST")
NONINVASIVE_DEVICES = ("Bipap mask ", "CPAP mask ")
HIGH_FLOW_DEVICES = ("High flow nasal cannula",)
OXYGEN_DEVICES = ("Non-rebreather", "Face tent", "Aerosol-cool", "Venti mask ", "Medium conc mask ", "Ultrasonic neb",
                  "Vapomist", "Oxymizer", "High flow neb", "Nasal cannula")
INVASIVE = "InvasiveVent"
MAX_TIDAL_VOLUME = 1500
INTUBATED_MODES = (*INVASIVE_MODES, *PRESSURE_SUPPORT_MODES)
INTUBATED_HAMILTON_MODES = (*HAMILTON_INVASIVE_MODES, HAMILTON_DUAL_MODE)
EPISODE_REACH_MINUTES = 239

# --- severity scores -----------------------------------------------------------------------------
CPAP_ITEM = 226732
CPAP_WORDS = ("cpap mask", "bipap")

AGE_POINTS = [("<", 40, 0), ("<", 60, 7), ("<", 70, 12), ("<", 75, 15), ("<", 80, 16), (">=", 80, 18)]
HEARTRATE_POINTS = [("min", "<", 40, 11), ("max", ">=", 160, 7), ("max", ">=", 120, 4), ("min", "<", 70, 2)]
HEARTRATE_NORMAL = (70, 120)
SYSBP_POINTS = [("min", "<", 70, 13), ("min", "<", 100, 5), ("max", ">=", 200, 2)]
SYSBP_NORMAL = (100, 200)
FEVER_LIMIT = 39
OXYGENATION_POINTS = [("<", 100, 11), ("<", 200, 9), (">=", 200, 6)]
URINE_POINTS = [("<", 500, 11), ("<", 1000, 4), (">=", 1000, 0)]
BUN_POINTS = [("<", 28, 0), ("<", 84, 6), (">=", 84, 10)]
WBC_POINTS = [("min", "<", 1, 12), ("max", ">=", 20, 3)]
WBC_NORMAL = (1, 20)
POTASSIUM_POINTS = [("min", "<", 3, 3), ("max", ">=", 5, 3)]
POTASSIUM_NORMAL = (3, 5)
SODIUM_POINTS = [("min", "<", 125, 5), ("max", ">=", 145, 1)]
SODIUM_NORMAL = (125, 145)
BICARBONATE_POINTS = [("<", 15, 6), ("<", 20, 3), (">=", 20, 0)]
BILIRUBIN_POINTS = [("<", 4, 0), ("<", 6, 4), (">=", 6, 9)]
COMA_POINTS = [("<", 3, None), ("<", 6, 26), ("<", 9, 13), ("<", 11, 7), ("<", 14, 5), ("<=", 15, 0)]
COMORBIDITY_POINTS = [("aids", 17), ("hem", 10), ("mets", 9)]
ADMISSION_POINTS = [("ScheduledSurgical", 0), ("Medical", 6), ("UnscheduledSurgical", 8)]

SEVERITY_CODES = {
    "aids": [CodeRule(9, 3, ranges=(("042", "044"),)), CodeRule(10, 3, ("B24",), (("B20", "B22"),))],
    "hem": [
        CodeRule(9, 5, ranges=(("20000", "20238"), ("20240", "20248"), ("20250", "20302"), ("20310", "20312"),
                               ("20302", "20382"), ("20400", "20522"), ("20580", "20702"), ("20720", "20892"))),
        CodeRule(9, 4, ("2386", "2733")),
        CodeRule(10, 3, ranges=(("C81", "C96"),)),
    ],
    "mets": [
        CodeRule(9, 4, ranges=(("1960", "1991"),)),
        CodeRule(9, 5, ("20979", "78951"), (("20970", "20975"),)),
        CodeRule(10, 3, ranges=(("C77", "C79"),)),
        CodeRule(10, 4, ("C800",)),
    ],
}

RESPIRATION_POINTS = [("<", 100, 4), ("<", 200, 3), ("<", 300, 2), ("<", 400, 1)]
LIVER_POINTS = [(">=", 12, 4), (">=", 6, 3), (">=", 2, 2), (">=", 1.2, 1)]
COAGULATION_POINTS = [("<", 20, 4), ("<", 50, 3), ("<", 100, 2), ("<", 150, 1)]

# --- comorbidity index ---------------------------------------------------------------------------
CHARLSON_AGE_POINTS = [("<", 50, 0), ("<", 60, 1), ("<", 70, 2), ("<", 80, 3)]


CHARLSON = {
    "myocardial_infarct": [
        CodeRule(9, 3, ("410", "412")), CodeRule(10, 3, ("I21", "I22")), CodeRule(10, 4, ("I252",)),
    ],
    "congestive_heart_failure": [
        CodeRule(9, 3, ("428",)),
        CodeRule(9, 5, ("39891", "40201", "40211", "40291", "40401", "40403", "40411", "40413", "40491", "40493")),
        CodeRule(9, 4, ranges=(("4254", "4259"),)),
        CodeRule(10, 3, ("I43", "I50")),
        CodeRule(10, 4, ("I099", "I110", "I130", "I132", "I255", "I420", "I425", "I426", "I427", "I428", "I429", "P290")),
    ],
    "peripheral_vascular_disease": [
        CodeRule(9, 3, ("440", "441")),
        CodeRule(9, 4, ("0930", "4373", "4471", "5571", "5579", "V434"), (("4431", "4439"),)),
        CodeRule(10, 3, ("I70", "I71")),
        CodeRule(10, 4, ("I731", "I738", "I739", "I771", "I790", "I792", "K551", "K558", "K559", "Z958", "Z959")),
    ],
    "cerebrovascular_disease": [
        CodeRule(9, 3, ranges=(("430", "438"),)),
        CodeRule(9, 5, ("36234",)),
        CodeRule(10, 3, ("G45", "G46"), (("I60", "I69"),)),
        CodeRule(10, 4, ("H340",)),
    ],
    "dementia": [
        CodeRule(9, 3, ("290",)), CodeRule(9, 4, ("2941", "3312")),
        CodeRule(10, 3, ("F00", "F01", "F02", "F03", "G30")), CodeRule(10, 4, ("F051", "G311")),
    ],
    "chronic_pulmonary_disease": [
        CodeRule(9, 3, ranges=(("490", "505"),)), CodeRule(9, 4, ("4168", "4169", "5064", "5081", "5088")),
        CodeRule(10, 3, ranges=(("J40", "J47"), ("J60", "J67"))), CodeRule(10, 4, ("I278", "I279", "J684", "J701", "J703")),
    ],
    "rheumatic_disease": [
        CodeRule(9, 3, ("725",)),
        CodeRule(9, 4, ("4465", "7100", "7101", "7102", "7103", "7104", "7140", "7141", "7142", "7148")),
        CodeRule(10, 3, ("M05", "M06", "M32", "M33", "M34")),
        CodeRule(10, 4, ("M315", "M351", "M353", "M360")),
    ],
    "peptic_ulcer_disease": [
        CodeRule(9, 3, ("531", "532", "533", "534")), CodeRule(10, 3, ("K25", "K26", "K27", "K28")),
    ],
    "mild_liver_disease": [
        CodeRule(9, 3, ("570", "571")),
        CodeRule(9, 4, ("0706", "0709", "5733", "5734", "5738", "5739", "V427")),
        CodeRule(9, 5, ("07022", "07023", "07032", "07033", "07044", "07054")),
        CodeRule(10, 3, ("B18", "K73", "K74")),
        CodeRule(10, 4, ("K700", "K701", "K702", "K703", "K709", "K713", "K714", "K715", "K717", "K760", "K762", "K763",
                "K764", "K768", "K769", "Z944")),
    ],
    "diabetes_without_cc": [
        CodeRule(9, 4, ("2500", "2501", "2502", "2503", "2508", "2509")),
        CodeRule(10, 4, ("E100", "E101", "E106", "E108", "E109", "E110", "E111", "E116", "E118", "E119", "E120", "E121",
                "E126", "E128", "E129", "E130", "E131", "E136", "E138", "E139", "E140", "E141", "E146", "E148", "E149")),
    ],
    "diabetes_with_cc": [
        CodeRule(9, 4, ("2504", "2505", "2506", "2507")),
        CodeRule(10, 4, ("E102", "E103", "E104", "E105", "E107", "E112", "E113", "E114", "E115", "E117", "E122", "E123",
                "E124", "E125", "E127", "E132", "E133", "E134", "E135", "E137", "E142", "E143", "E144", "E145", "E147")),
    ],
    "paraplegia": [
        CodeRule(9, 3, ("342", "343")),
        CodeRule(9, 4, ("3341", "3440", "3441", "3442", "3443", "3444", "3445", "3446", "3449")),
        CodeRule(10, 3, ("G81", "G82")),
        CodeRule(10, 4, ("G041", "G114", "G801", "G802", "G830", "G831", "G832", "G833", "G834", "G839")),
    ],
    "renal_disease": [
        CodeRule(9, 3, ("582", "585", "586", "V56")),
        CodeRule(9, 4, ("5880", "V420", "V451"), (("5830", "5837"),)),
        CodeRule(9, 5, ("40301", "40311", "40391", "40402", "40403", "40412", "40413", "40492", "40493")),
        CodeRule(10, 3, ("N18", "N19")),
        CodeRule(10, 4, ("I120", "I131", "N032", "N033", "N034", "N035", "N036", "N037", "N052", "N053", "N054", "N055",
                "N056", "N057", "N250", "Z490", "Z491", "Z492", "Z940", "Z992")),
    ],
    "malignant_cancer": [
        CodeRule(9, 3, ranges=(("140", "172"), ("200", "208"))),
        CodeRule(9, 4, ("2386",), (("1740", "1958"),)),
        CodeRule(10, 3, ("C43", "C88"), (("C00", "C26"), ("C30", "C34"), ("C37", "C41"), ("C45", "C58"),
                                            ("C60", "C76"), ("C81", "C85"), ("C90", "C97"))),
    ],
    "severe_liver_disease": [
        CodeRule(9, 4, ("4560", "4561", "4562"), (("5722", "5728"),)),
        CodeRule(10, 4, ("I850", "I859", "I864", "I982", "K704", "K711", "K721", "K729", "K765", "K766", "K767")),
    ],
    "metastatic_solid_tumor": [
        CodeRule(9, 3, ("196", "197", "198", "199")), CodeRule(10, 3, ("C77", "C78", "C79", "C80")),
    ],
    "aids": [
        CodeRule(9, 3, ("042", "043", "044")), CodeRule(10, 3, ("B20", "B21", "B22", "B24")),
    ],
}
# flags that count once; the others enter through the hierarchy in the comorbidity index
CHARLSON_SINGLE = ("myocardial_infarct", "congestive_heart_failure", "peripheral_vascular_disease",
                   "cerebrovascular_disease", "dementia", "chronic_pulmonary_disease", "rheumatic_disease",
                   "peptic_ulcer_disease")
