"""Ethical-clearance normaliser and study-title groups: ordered LIKE rules as data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandmart.functions.text import as_col, first_rule


@dataclass(frozen=True)
class Study:
    number: str
    title: str
    investigator: str


# Studies as they must appear in the result.
PSORIASIS_1 = Study(
    "2774/UN14.2.2.VII.14/LT/2022",
    "ANALISIS GENETIK PADA PSORIASIS VULGARIS",
    "Dr. dr. I G. N. Darmaputra, Sp.KK(K), FINSDV, FAADV",
)
PSORIASIS_2 = Study(
    "0512/UN14.2.2.VII.14/LT/2024",
    "ANALISIS GENETIK PADA PSORIASIS VULGARIS (Tahap 2)",
    "Dr. dr. I G. N. Darmaputra, Sp.KK(K), FINSDV, FAADV",
)
CANCER = Study(
    "286/KEPK/XII/2022",
    "GERCEP (Genomik Kanker untuk Pencegahan dan Terapi Presisi) BGSI Rumah Sakit Kanker Dharmais 2022 - 2023",
    "dr. Rizky Ifandriani Putri, Sp. PA",
)
DUCHENNE = Study(
    "KE/FK/0017/EC/2023",
    "NEXT GENERATION SEQUENCING UNTUK PASIEN DUCHENNE MUSCULAR DYSTROPHY (DMD) di INDONESIA",
    "dr. Gunadi, Ph.D, Sp.BA",
)
DIABETES_ADULT = Study(
    "KET-1203/UN2.F1/ETIK/PPM.00.02/2023",
    "Studi Genomik pada Pasien Diabetes Melitus Dewasa",
    "dr. Dicky Levenus Tahapary, SpPD, K-EMD, Ph.D",
)
DIABETES_YOUNG = Study(
    "KET-872/UN2.F1/ETIK/PPM.00.02/2022",
    "Studi Genomik pada Pasien Diabetes Melitus Awitan Usia Muda",
    "dr. Dicky Levenus Tahapary, SpPD, K-EMD, Ph.D",
)
TB_2023 = Study(
    "KET-42/UN2.F1/ETIK/PPM.00.02/2023",
    "Analisis Genomik Manusia dan Mycobacterium Tuberculosis pada Kasus TBC Paru Sensitif dan Resisten Obat di Indonesia",
    "dr. Pompini Agustina Sitompul, Sp.P (K)",
)
TB_2024 = Study(
    "S-252/UN2.F1/ETIK/PPM.00.02/2024",
    "Analisis Genomik Manusia dan Mycobacterium tuberculosis pada Kasus TBC Paru Sensitif dan Resisten Obat di Indonesia",
    "dr. Pompini Agustina Sitompul, Sp.P (K)",
)
# Found by title: the title text is the one of 2024 in both years.
TB_2023_BY_TITLE = Study(TB_2023.number, TB_2024.title, TB_2023.investigator)
CLOPIDOGREL = Study(
    "LB.02.01/KEP/042/2022",
    "Clopidogrel Resistance Study in Ischemic Stroke of Indonesian Population",
    "dr. Mursyid Bustami, Sp.S(K), KIC, MARS",
)

# Rules on the clearance number, in order.
NUMBER_RULES = [
    ("%VII.14/LT/2024", PSORIASIS_2),
    ("%VII.14/LT/2022", PSORIASIS_1),
    ("%KEPK/XII/2022%", CANCER),
    ("%KE/FK/0017/EC/2023", DUCHENNE),
    ("KET-1203/UN2.F1/ETIK/PPM.00.02%", DIABETES_ADULT),
    ("%KET-42/UN2.F1/ETIK/PPM.00.02/2023%", TB_2023),
    ("%KET-872/UN2.F1/ETIK/PPM.00.02/2022%", DIABETES_YOUNG),
    ("%LB.02.01/KEP/042/2022%", CLOPIDOGREL),
    ("%S-252/UN2.F1/ETIK/PPM.00.02/2024%", TB_2024),
    ("%Studi Genomik pada Pasien Diabetes Melitus Awitan Usia Muda%", DIABETES_YOUNG),
]
PI_RULE = ("%KET-872/UN2.F1/ETIK/PPM.00.02/2022%", DIABETES_YOUNG)

# Rules on the title for two study series, by year of the record (before 2024, since).
SERIES_RULES = [
    ("ANALISIS GENOMIK PADA PSORIASIS%", PSORIASIS_1, PSORIASIS_2),
    ("%dan Mycobacterium%", TB_2023_BY_TITLE, TB_2024),
]
SERIES_YEAR = 2024

# Title rules that touch only some columns, for another number than the study's own:
# (title, number must not be like, rule also for a missing number, study, columns)
TITLE_RULES = [
    ("%Studi Genomik pada Pasien Diabetes Melitus Dewasa%",
     "%KET-1203/UN2.F1/ETIK/PPM.00.02/2023%", False, DIABETES_ADULT, ("number",)),
    ("%GERCEP (Genomik Kanker untuk Pencegahan dan Terapi Presisi) BGSI Rumah Sakit Kanker Dharmais 2022 - 2023%",
     "%286/KEPK/XII/2022%", False, CANCER, ("number", "investigator")),
    ("%Clopidogrel Resistance Study in Ischemic Stroke of Indonesian Population%",
     "%LB.02.01/KEP/042/2022%", True, CLOPIDOGREL, ("number",)),
]

# Title groups of the dashboard, for rows with one study only.
TITLE_GROUPS = [
    ("%(AMI) Polygenic Risk Score (PRS)%",
     "Validation of Acute Myocardial Infarction (AMI) Polygenic Risk Score (PRS) Using Whole Genome Sequencing (WGS) for Indonesian Population"),
    ("%ANALISIS GENETIK PADA PSORIASIS VULGARIS%", "ANALISIS GENETIK PADA PSORIASIS VULGARIS"),
    ("%bacterium%",
     "Analisis Genomik Manusia & Mycobacterium Tuberculosis pada Kasus TBC Paru Sensitif dan Resistensi Obat di Indonesia"),
    ("%Pulmonary Hypertension and Congenital Heart Disease in Adult Patients%",
     "Determinant and Prognostic Factors (Clinical, Mollecular, and Genetics) of Pulmonary Hypertension and Congenital Heart Disease in Adult Patients"),
    ("%GERCEP (Genomik Kanker untuk Pencegahan dan Terapi Presisi)%", CANCER.title),
    ("%Studi Genomik pada Pasien Diabetes Melitus Dewasa%",
     "Studi Genomik Multisenter pada Pasien Diabetes Mellitus (Dewasa)"),
    ("%Studi Genomik pada Pasien Diabetes Melitus Awitan Usia Muda%",
     "Studi Genomik Multisenter pada Pasien Diabetes Mellitus (Awitan Usia Muda)"),
]


def _conditions(number: Column, title: Column, investigator: Column, year: Column):
    rules = [(number.ilike(pattern), study, None) for pattern, study in NUMBER_RULES]
    rules.append((investigator.ilike(PI_RULE[0]), PI_RULE[1], None))
    for pattern, before, since in SERIES_RULES:
        rules.append((title.ilike(pattern) & (year < SERIES_YEAR), before, None))
        rules.append((title.ilike(pattern) & (year >= SERIES_YEAR), since, None))
    for pattern, other, also_missing, study, columns in TITLE_RULES:
        differs = F.coalesce(~number.ilike(other), F.lit(also_missing))
        rules.append((title.ilike(pattern) & differs, study, columns))
    return rules


def normalise_clearance(number, title, investigator, logged_at) -> dict[str, Column]:
    """``number``, ``title`` and ``investigator`` after the ordered rules."""
    raw = {"number": as_col(number), "title": as_col(title), "investigator": as_col(investigator)}
    rules = _conditions(*raw.values(), F.year(as_col(logged_at)))
    out = {}
    for name, column in raw.items():
        mine = [
            (condition, getattr(study, name))
            for condition, study, columns in rules
            if columns is None or name in columns
        ]
        out[name] = first_rule(mine, column)
    return out


def title_group(title) -> Column:
    title = as_col(title)
    single = ~title.contains(";")
    return first_rule([(title.ilike(p) & single, name) for p, name in TITLE_GROUPS], title)
