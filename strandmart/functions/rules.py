"""Classification rules outside sample QC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandmart.functions.text import (
    as_col,
    capture_or_null,
    clean_null,
    first_rule,
    recode,
    regexp_or_null,
)

# Hospital names.
RSCM = "RS Dr. Cipto Mangunkusumo"
DHARMAIS = "RS Kanker Dharmais"
PON = "RS PON Prof. Dr. dr. Mahar Mardjono"
NGOERAH = "RSUP Prof. Dr. IGNG Ngoerah Denpasar"
SARDJITO = "RSUP Dr. Sardjito"
SULIANTI = "RSPI Prof. Dr. Sulianti Saroso"
PERSAHABATAN = "RSUP Persahabatan"
HARAPAN_KITA_CHILD = "PKIAN RSAB Harapan Kita"
HARAPAN_KITA_HEART = "RSPJD Harapan Kita"

# Hospital codes of the event log.
HOSPITAL_CODES = {
    "RS_KANKER_DHARMAIS": DHARMAIS,
    "RS_PERSAHABATAN": PERSAHABATAN,
    "RS_PON": PON,
    "RS_SANGLAH": NGOERAH,
    "RS_SARDJITO": SARDJITO,
    "RS_SULIANTI_SAROSO": SULIANTI,
    "RSCM": RSCM,
}
TB_CODES = ("RS_PERSAHABATAN", "RS_SULIANTI_SAROSO")
TB_HOSPITALS = (PERSAHABATAN, SULIANTI)
TB_BIOBANKS = ("Biobank RSPI Prof. Dr. Sulianti Saroso", "Biobank RSUP Persahabatan")

# Fragments of the creator's e-mail address; None is the coordinating site.
EMAIL_SITES = [
    ("rspon", PON),
    ("sardjitohospital", SARDJITO),
    ("rscm", RSCM),
    ("rsabhk", HARAPAN_KITA_CHILD),
    ("dharmais", DHARMAIS),
    ("pjnhk", HARAPAN_KITA_HEART),
    ("sintayunita|admin", None),
    ("profngoerahhospitalbali", NGOERAH),
    ("rspisuliantisaroso", SULIANTI),
    ("rsuppersahabatan", PERSAHABATAN),
]

# Upper-case hospital names of the basic-info table.
UPPER_HOSPITALS = [NGOERAH, PERSAHABATAN, SARDJITO, SULIANTI, PON, DHARMAIS, RSCM]

# Biobank name fragments.
BIOBANK_SITES = [
    ("RSCM", RSCM),
    (" RSPI Prof. Dr. Sulianti Saroso", SULIANTI),
    ("RSUP Dr. Sardjito", SARDJITO),
    ("RS PON Prof. Dr. dr. Mahar Mardjono", PON),
    ("Biobank RSUP Persahabatan", PERSAHABATAN),
    ("Biobank RS Kanker Dharmais", DHARMAIS),
    ("Biobank RSUP Prof. Dr. IGNG Ngoerah Denpasar", NGOERAH),
]

# Recruitment targets per site; None is the coordinating site.
TARGETS = [
    (None, 2468),
    (HARAPAN_KITA_CHILD, 1500),
    (RSCM, 3800),
    (DHARMAIS, 4800),
    (PON, 1950),
    (SULIANTI, 1250),
    (HARAPAN_KITA_HEART, 1000),
    (SARDJITO, 900),
    (PERSAHABATAN, 1250),
    (NGOERAH, 1400),
]

# Biobanks that hand over to central sequencing.
CENTRAL_BIOBANKS = ("Biobank Sentral (BB Binomika)", "Biobank Pusat")

# Specimen flags.
SPECIMENS = {
    "buffycoat": "Buffycoat",
    "plasma": "Plasma EDTA",
    "urin": "Urine",
    "dna": "DNA",
    "whole_blood": "Whole Blood",
    "serum": "Serum",
    "sputum": "Sputum",
    "isolat": "Isolat",
    "airmata": "Air Mata",
    "jaringan": "Jarigan",
}

# Dose recommendations by category.
DOSES = {
    1: "Change Prescription",
    2: "Increase Starting Dose",
    3: "Decrease Starting Dose",
    4: "Increase Monitoring",
    5: "Follow Standard Dosing",
}

# Province spellings and ISO codes.
PROVINCES = {
    "YOGYAKARTA": "DAERAH ISTIMEWA YOGYAKARTA",
    "RIAU": "KEPULAUAN RIAU",
    "KEP. BANGKA BELITUNG": "KEPULAUAN BANGKA BELITUNG",
}
NEW_PAPUA = ("ID-PS", "ID-PT", "ID-PE")

SURVEY_TITLE = "Survei Kesehatan Indonesia (SKI) 2023"
GENERAL_POPULATION = "POPULASI UMUM"
CONTROL, PATIENT = "KONTROL", "PASIEN"

SEX_WORDS = {"Perempuan": "FEMALE", "Laki-laki": "MALE"}
KARYOTYPES = {"female": "XX", "male": "XY"}


def sex_from_word(c) -> Column:
    return recode(c, SEX_WORDS, keep_other=False)


def karyotype_from_word(c) -> Column:
    return recode(F.lower(as_col(c)), KARYOTYPES, keep_other=False)


def visit_category(icd, control: str = "Control", patient: str = "Patient") -> Column:
    """Control visits carry an ICD code that starts with Z00; a missing code is a patient."""
    return F.when(as_col(icd).ilike("z00%"), control).otherwise(patient)


def pgx_status(requested, english, local) -> Column:
    requested = as_col(requested).isNotNull()
    reported = as_col(english).isNotNull() | as_col(local).isNotNull()
    return first_rule(
        [
            (requested & reported, "Successful Run"),
            (requested, "Failed Run"),
            (~reported, "Uncompleted Run"),
        ]
    )


def registry_status(*ids) -> Column:
    return F.when(F.coalesce(*[as_col(c) for c in ids]).isNull(), "Not In Registry").otherwise(
        "In Registry"
    )


def central_sequencing(is_biobank, origin) -> Column:
    to_lab = (as_col(is_biobank).cast("string") == "0") & as_col(origin).isin(*CENTRAL_BIOBANKS)
    return F.when(to_lab, 1).otherwise(0)


def dose_text(category) -> Column:
    rec = as_col(category).try_cast("int")
    return first_rule([(rec == key, text) for key, text in DOSES.items()])


def specimen_flag(name, wanted: str) -> Column:
    return F.when(F.lower(as_col(name)) == wanted.lower(), 1).otherwise(0)


def hospital_from_code(code) -> Column:
    return recode(code, HOSPITAL_CODES, keep_other=False)


def hospital_from_email(email, central_site: str) -> Column:
    email = as_col(email)
    return first_rule(
        [(email.rlike(p), name or central_site) for p, name in EMAIL_SITES], F.lit("Unknown")
    )


def hospital_from_upper(name) -> Column:
    """Known names in upper case to their usual spelling, others null."""
    upper = F.upper(as_col(name))
    return first_rule([(upper == h.upper(), h) for h in UPPER_HOSPITALS])


def hospital_from_biobank(name) -> Column:
    name = as_col(name)
    return first_rule([(name.ilike(f"%{p}%"), h) for p, h in BIOBANK_SITES], name)


def first_biobank_site(names) -> Column:
    """First of a ``; `` list, without the word Biobank."""
    return F.regexp_replace(as_col(names), "(?i)(Biobank |; .+)", "")


def participant_type(title, registry, biobank, hospital, central_site: str) -> Column:
    """Registry type before biobank type; general population depends on the study."""
    title, biobank = as_col(title), as_col(biobank)
    own = F.trim(F.coalesce(as_col(registry), biobank))
    survey = title == SURVEY_TITLE
    other_study = F.coalesce(title != SURVEY_TITLE, F.lit(True))
    control_at_centre = (as_col(hospital) == central_site) & (biobank == CONTROL)
    return first_rule(
        [
            (survey & (own != GENERAL_POPULATION), GENERAL_POPULATION),
            (other_study & control_at_centre, GENERAL_POPULATION),
            (other_study & (own == GENERAL_POPULATION), CONTROL),
        ],
        own,
    )


def province_name(c) -> Column:
    fixed = recode(c, PROVINCES)
    return F.when(~as_col(c).isin("-", ""), fixed)


def province_iso(c) -> Column:
    c = as_col(c)
    return F.when(c == "ID-PD", "ID-PB").when(c.isin(*NEW_PAPUA), "ID-PA").otherwise(c)


def exclusion(site_excluded, subject_excluded) -> Column:
    return F.coalesce(as_col(site_excluded), F.lit(False)) | F.coalesce(
        as_col(subject_excluded), F.lit(False)
    )


def exclusion_reason(site_excluded, reason) -> Column:
    return F.when(
        F.coalesce(as_col(site_excluded), F.lit(False)),
        "TB Exclusion due to not having BC/Plasma",
    ).otherwise(as_col(reason))


# --- sample and run names -------------------------------------------------

UUID = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"

# Run folders of the Illumina QC report, tried in order.
RUN_FOLDERS = [
    "^(.*)-DRAGEN_Germline_WGS_4-2-7.*",
    "^(.*)-DRAGEN_Germline_WGS_4-2-6-v2.*",
    rf"^([A-Z0-9]{{12}}_[a-zA-Z0-9]{{8}}_rerun_\d{{4}}-\d{{2}}-\d{{2}}_\d+)-{UUID}",
]

# Sample ids inside a run name: (shape of the run name, id inside it).
RUN_SAMPLE_IDS = [
    ("^SKI_", "SKI_[^_]+"),
    (r"^[^_]+_\d{6}_M_", r"[^_]+_\d{6}_[TM]"),
    ("^[^_-]+-1-DRAGEN-4-2-6-Germline", "[^_-]+"),
]


def run_from_folder(folder) -> Column:
    """Run name of a QC folder: three shapes, else the text before the first dash."""
    folder = as_col(folder)
    shapes = [capture_or_null(folder, p) for p in RUN_FOLDERS]
    return F.coalesce(*shapes, F.split(folder, "-")[0])


def sample_from_run(run) -> Column:
    """Sample id of a run name: three shapes, else the text before the first underscore."""
    run = as_col(run)
    rules = [(run.rlike(shape), regexp_or_null(run, ident)) for shape, ident in RUN_SAMPLE_IDS]
    return first_rule(rules, F.split(run, "_")[0])


def sample_from_reference(ref) -> Column:
    """Sample id of a user reference."""
    ref = as_col(ref)
    return first_rule(
        [
            (ref.rlike("^SKI"), F.array_join(F.slice(F.split(ref, "_"), 1, 2), "_")),
            (ref.rlike("(_M|_T)$"), ref),
            (ref.rlike("^DRAGEN"), F.split(ref, "-")[0]),
        ],
        F.split(ref, "_")[0],
    )


def run_from_path(path, buckets) -> Column:
    """Run folder of an object path; the more specific bucket is tried first."""
    path = as_col(path)
    nested = f"{buckets.dragen_liquid}/pro/analysis"
    # (text in the path, folder before the run, keep only the part before the first dash)
    places = [
        (buckets.citus_liquid, buckets.citus_liquid, True),
        (f"{nested}/", nested, True),
        (buckets.dragen_liquid, buckets.dragen_liquid, True),
        (buckets.citus, buckets.citus, False),
        (buckets.ont_output, buckets.ont_output, False),
        (buckets.illumina, f"{buckets.illumina}/pro/analysis", True),
    ]
    rules = []
    for found, folder, cut in places:
        run = F.regexp_extract(path, f"{folder.replace('.', '[.]')}/([^/]+)/", 1)
        rules.append((path.contains(found), F.split(run, "-")[0] if cut else run))
    return first_rule(rules, F.lit(""))


def sample_and_run_from_path(path, buckets) -> Column:
    """struct(id_repository, run_name)."""
    run = run_from_path(path, buckets)
    return F.struct(sample_from_run(run).alias("id_repository"), run.alias("run_name"))


def zlims_sample_id(c) -> Column:
    return F.split(as_col(c), "[-_]")[0]


# Fixed value: ids that are trials or controls of the sample sheet.
ZLIMS_TRIALS = "(?i)tes|^BC|SAMPLE|^DNB"

# Words that mark controls in the unified sample table.
CONTROL_WORDS = ("test", "pro", "mla", "sp500", "gk-p5", "gk-p3", "control", "t011")


def is_control_sample(c) -> Column:
    low = F.lower(as_col(c))
    found = low.contains(CONTROL_WORDS[0])
    for word in CONTROL_WORDS[1:]:
        found = found | low.contains(word)
    return found


def missing_or_dash(c) -> Column:
    return clean_null(c).isNull() | (as_col(c) == "-")
