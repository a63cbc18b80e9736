"""One row per subject, hospital and clearance, from two registries and the biobank.

Each step is a function of the table mapping, so it can be tested alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandmart.functions import rules
from strandmart.functions.clearance import normalise_clearance, title_group
from strandmart.functions.dates import age_years, fix_birth_century
from strandmart.functions.text import regexp_or_null, unquote
from strandmart.operators.aggregates import concat_distinct, distinct_text, sorted_text
from strandmart.operators.joins import anti_null_safe, anti_on, left_on, lookup, semi_on
from strandmart.operators.ranking import latest_by
from strandmart.operators.shape import union_padded
from strandmart.plans.steps import numbered, once
from strandmart.session import hold_texts
from strandmart.settings import Settings

# Form names and answer paths.
CLEARANCE_FORM = "ethical-clearance-v1"
CLEARANCE_PREFIX = "ethical-clearance-v1/episode_of_care_-_institution/"
HEART_FORM = "genetic-disorders-pah-registrasi-v2"
HEART_PATH = "genetic-disorders-pah-registrasi-v2/registrasi/identitas/tipe_pasien:0|value"
DEMOGRAPHY_FORM = "demography-v2"
CLEARANCE_ANSWER = "Nomor EC"
TYPE_ANSWERS = {
    "phenovar_docs_rekrutmen_registrasi": "Koleksi Sampel|Tipe Partisipan",
    "phenovar_docs_rekrutmen_basic": "Admisi Partisipan|Tipe Partisipan",
}
# Trial subjects of the document form, and one subject of another site.
TRIAL_SUBJECTS = (
    "AAA00001", "AAA01410", "AAA01419", "AAA01420", "AAA01423", "AAA01424", "AAA01425", "AAA01427",
    "AAA01428", "AAA01429",
)
OTHER_SITE_SUBJECT = "AAA01156"
LEADING_BLANKS = r"(^[ ]+)|[\t\n\x0B\f]+"
# Rows of a group are dealt to a part for each so many characters of its text, and to so many parts at most.
PART_TEXT = 1 << 16
MOST_PARTS = 64


# --- clearances and participant types ------------------------------------


def _answers(composition, fields: dict[str, str]):
    """Named answers of one composition, parsed once."""
    inner = ", ".join(f"`{path}`: string" for path in fields.values())
    parsed = F.from_json(composition, f"composition struct<{inner}>")
    return {name: parsed["composition"][path] for name, path in fields.items()}


def registry_a_clearances(tables) -> DataFrame:
    """Normalised clearance numbers, titles and investigators per subject."""
    log = tables["regina_log"].filter(F.col("template_id") == CLEARANCE_FORM)
    fields = {
        "number": CLEARANCE_PREFIX + "nomor_ethical_clearance",
        "title": CLEARANCE_PREFIX + "judul_penelitian",
        "investigator": CLEARANCE_PREFIX + "nama_peneliti_pi",
    }
    raw = {
        n: F.regexp_replace(unquote(c), LEADING_BLANKS, "") for n, c in _answers("composition", fields).items()
    }
    rows = log.select(F.col("ehr_id").alias("id_subject"), "logged_at", *[c.alias(n) for n, c in raw.items()])
    rows = rows.filter(F.col("title").isNotNull() & F.col("investigator").isNotNull())
    rows = rows.select(
        "id_subject",
        *[c.alias(n) for n, c in normalise_clearance("number", "title", "investigator", "logged_at").items()],
    )
    names = {"number": "nomor_ec", "title": "judul_penelitian", "investigator": "nama_pi"}
    return concat_distinct(rows, ["id_subject"], names, ": ")


def registry_b_clearances(tables) -> DataFrame:
    """Clearances of the registration form, and of the system documents."""
    forms = tables["phenovar_docs_rekrutmen_registrasi"].filter(F.col("path") == CLEARANCE_ANSWER)
    forms = left_on(
        forms.select("id_subject", F.col("value").alias("nomor_ec")), tables["phenovar_ethical_clearance"],
        {"nomor_ec": "ec_number"}, {"research_title": "judul_penelitian"},
    )
    text = F.col("question_answer").cast("string")

    def answer(name):
        found = regexp_or_null(text, f"'{name}': '[^']+'")
        return F.regexp_replace(found, f"('{name}': |')", "")

    documents = tables["phenovar_documents"].filter(
        (F.col("institution_name") == "system") & ~F.col("participant_id").isin(*TRIAL_SUBJECTS)
    ).select(
        F.col("participant_id").alias("id_subject"),
        answer("Nomor EC").alias("nomor_ec"), answer("Judul Penelitian").alias("judul_penelitian"),
    )
    columns = ["nomor_ec", "judul_penelitian"]
    first = concat_distinct(forms, ["id_subject"], columns, "; ")
    second = concat_distinct(documents, ["id_subject"], columns, ",")
    return first.unionByName(second).distinct()


def registry_a_types(tables) -> DataFrame:
    """Patient or nothing, only for the heart-disease form."""
    log = tables["regina_log"].filter(F.col("template_id") == HEART_FORM)
    kind = _answers("composition", {"kind": HEART_PATH})["kind"]
    rows = log.select(F.col("ehr_id").alias("id_subject"), F.upper(unquote(kind)).alias("kind"))
    rows = left_on(
        rows, tables["demography_corrected_participant_type"], {"id_subject": "id_subject"},
        {"corrected_participant_type": "_fix"},
    )
    final = F.when(F.upper(F.coalesce("_fix", "kind")) == "PATIENT", rules.PATIENT)
    return rows.groupBy("id_subject").agg(F.max(final).alias("participant_type"))


def registry_b_types(tables) -> DataFrame:
    fixes = tables["demography_corrected_participant_type"]
    parts = [
        tables[table].filter(F.col("path") == path).select("id_subject", F.col("value").alias("participant_type"))
        for table, path in TYPE_ANSWERS.items()
    ]
    parts.append(fixes.select("id_subject", F.col("corrected_participant_type").alias("participant_type")))
    rows = union_padded(parts, {"id_subject": "string", "participant_type": "string"})
    rows = left_on(rows, fixes, {"id_subject": "id_subject"}, {"corrected_participant_type": "_fix"})
    rows = rows.select("id_subject", F.upper(F.coalesce("_fix", "participant_type")).alias("participant_type"))
    return concat_distinct(rows, ["id_subject"], ["participant_type"], ",")


# --- registry subjects ----------------------------------------------------

PERSON = {
    "regina_id_subject": "string", "phenovar_id_subject": "string", "birth_date": "date", "sex": "string",
    "province": "string", "creation_date": "timestamp", "nomor_ec": "string", "judul_penelitian": "string",
    "participant_type": "string", "_duplicate": "bigint",
}


def registry_a_persons(tables) -> DataFrame:
    """First record per subject and national id, with the id in the other registry."""
    people = tables["decrypt_regina"].select("id_subject", "nik", "birthdate", "gender", "creationDate")
    first = latest_by(people, ["id_subject", "nik"], [F.asc_nulls_first("creationDate")])
    moved = left_on(
        first, tables["regina_migration"], {"id_subject": "id_subject_regina"},
        {"phenovar_id_subject": "phenovar_id_subject", "provinsi": "province"},
    )
    moved = left_on(
        moved, registry_a_clearances(tables), {"id_subject": "id_subject"}, ["nomor_ec", "judul_penelitian"]
    )
    return moved.select(
        F.col("id_subject").alias("regina_id_subject"), "phenovar_id_subject",
        F.col("birthdate").alias("birth_date"), rules.sex_from_word("gender").alias("sex"),
        F.upper("province").alias("province"), F.col("creationDate").alias("creation_date"),
        "nomor_ec", "judul_penelitian",
    ).distinct()


def moved_subjects(tables) -> DataFrame:
    """Ids in the younger registry of subjects known to the older one."""
    moved = tables["regina_migration"].filter(F.col("phenovar_id_subject").isNotNull())
    return semi_on(moved, tables["decrypt_regina"], "id_subject_regina", "id_subject").select("phenovar_id_subject")


def registry_b_persons(tables) -> DataFrame:
    people = left_on(
        tables["decrypted_phenovar_participants"], registry_b_clearances(tables), {"id_subject": "id_subject"},
        ["nomor_ec", "judul_penelitian"],
    )
    return people.select(
        "nik", "full_name", F.col("id_subject").alias("phenovar_id_subject"),
        fix_birth_century("birth_date").alias("birth_date"), F.upper("sex").alias("sex"),
        F.upper("province").alias("province"), F.col("created_at").alias("creation_date"),
        "nomor_ec", "judul_penelitian",
    )


def same_name_and_id(people: DataFrame) -> DataFrame:
    """Subjects that share a full name and a national id; unknown names match nobody."""
    known = people.filter(F.col("full_name").isNotNull() & F.col("nik").isNotNull())
    groups = known.groupBy("full_name", "nik").agg(
        F.count(F.lit(1)).alias("ct"),
        sorted_text("phenovar_id_subject", ",").alias("duplicate_name_nik_id_subject"),
    )
    return groups.filter("ct > 1").drop("ct")


def duplicate_texts(tables, people: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``full_name``, ``nik`` and ``_duplicate``, and the text of each ``_duplicate``: numbers in the order of the texts.

    All members of a group have the group's whole text, so rows that carried it would grow with the square of the group.  They
    carry its number, which compares and ties as the text does, and get the text when nothing is left to sort or shuffle.
    """
    groups = once(tables, "same_name_and_id", same_name_and_id(people))
    column = "duplicate_name_nik_id_subject"
    texts = numbered(tables, "duplicate_texts", groups.select(column).distinct().orderBy(column), "_duplicate")
    return left_on(groups, texts, {column: column}, ["_duplicate"]).select("full_name", "nik", "_duplicate"), texts


def with_texts(tables, rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows with their group's text, those of a group side by side.

    A file that holds a text on row after row stores it once; dealt by anything else, each file would hold all texts again and again.
    A large group, and the rows without one, lie in several parts, so no task has them whole.
    """
    text = "duplicate_name_nik_id_subject"
    hold_texts(rows.sparkSession, text)
    parts = F.least(F.lit(MOST_PARTS), F.floor(F.length(text) / PART_TEXT).cast("int") + 1)
    long = once(tables, "long_texts", texts.select("_duplicate", parts.alias("_parts")).filter("_parts > 1"))
    rows = left_on(rows, long, {"_duplicate": "_duplicate"}, ["_parts"])
    of = F.when(F.col("_duplicate").isNull(), MOST_PARTS).otherwise(F.coalesce("_parts", F.lit(1)))
    rows = rows.withColumn("_part", F.pmod(F.hash("id_subject"), of)).drop("_parts")
    rows = rows.repartition("_duplicate", "_part").sortWithinPartitions("_duplicate", "_part")
    copies = texts.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return left_on(rows, copies, {"_duplicate": "_duplicate", "_part": "_part"}, [text]).drop("_part")


def all_persons(tables) -> tuple[DataFrame, DataFrame]:
    """Both registries, a subject that moved counts once, under the older registry; and the texts of ``_duplicate``."""
    a, b = registry_a_persons(tables), once(tables, "registry_b", registry_b_persons(tables))
    merged = left_on(
        a, b, {"phenovar_id_subject": "phenovar_id_subject"},
        {"nomor_ec": "_ec", "judul_penelitian": "_title"},
    )
    merged = merged.withColumns(
        {"nomor_ec": F.coalesce("nomor_ec", "_ec"), "judul_penelitian": F.coalesce("judul_penelitian", "_title")}
    )
    merged = left_on(merged, registry_a_types(tables), {"regina_id_subject": "id_subject"}, ["participant_type"])

    only_b = anti_on(b, moved_subjects(tables), "phenovar_id_subject", "phenovar_id_subject")
    only_b = left_on(only_b, registry_b_types(tables), {"phenovar_id_subject": "id_subject"}, ["participant_type"])
    only_b = once(tables, "only_registry_b", only_b)
    groups, texts = duplicate_texts(tables, only_b)
    only_b = left_on(only_b, groups, {"nik": "nik", "full_name": "full_name"}, ["_duplicate"])
    return union_padded([merged, only_b], PERSON).distinct(), texts


def subjects(tables) -> tuple[DataFrame, DataFrame]:
    """Subjects with age, exclusion and all their clearances as one text; and the texts of ``_duplicate``."""
    people, texts = all_persons(tables)
    # An exclusion may name either id: two joins on unique keys instead of a join with OR.
    reasons = once(tables, "exclusions", tables["demography_exclusion"].groupBy("id_subject").agg(F.min("reason").alias("reason")))
    for i, column in enumerate(("regina_id_subject", "phenovar_id_subject")):
        people = left_on(
            people, reasons, {column: "id_subject"}, {"id_subject": f"_hit{i}", "reason": f"_reason{i}"}
        )
    people = people.withColumns(
        {
            "id_subject": F.coalesce("regina_id_subject", "phenovar_id_subject"),
            "age_at_recruitment": age_years("birth_date", "creation_date"),
            "is_excluded": F.col("_hit0").isNotNull() | F.col("_hit1").isNotNull(),
            "exclusion_reason": F.least("_reason0", "_reason1"),
        }
    )
    keys = (
        "id_subject regina_id_subject phenovar_id_subject sex province age_at_recruitment creation_date "
        "participant_type is_excluded"
    ).split()
    out = people.groupBy(*keys).agg(
        F.min("exclusion_reason").alias("exclusion_reason"),
        F.min("_duplicate").alias("_duplicate"),
        distinct_text("nomor_ec", "; ").alias("nomor_ec"),
        distinct_text("judul_penelitian", "; ").alias("judul_penelitian"),
    ).withColumnRenamed("participant_type", "registry_participant_type")
    return out, texts


# --- biobank --------------------------------------------------------------


def specimens(tables) -> DataFrame:
    """Samples with subject, biobank and specimen; samples without a subject, or with a dash for one, match nobody."""
    out = left_on(
        tables["simbiox_biosamples"].select("id_patient", "id_biobank", "biosample_specimen", "origin_code_repository"),
        tables["simbiox_patients"], {"id_patient": "id_patient"}, ["id_subject"],
    ).filter(~rules.missing_or_dash("id_subject"))
    out = lookup(out, tables["master_biobank"], {"id_biobank": "id_biobank"}, ["biobank_nama"])
    return lookup(out, tables["master_specimen"], {"biosample_specimen": "id"}, ["specimen_type_name"])


def _flags():
    return {n: rules.specimen_flag("specimen_type_name", w) == 1 for n, w in rules.SPECIMENS.items()}


def biobank_subjects(rows: DataFrame) -> DataFrame:
    """Rows per specimen, all origin codes, and whether the subject takes part at one of the two tuberculosis biobanks, in one aggregation.

    Such a subject has a usable specimen there; ``tb_site`` is the hospital.
    """
    flags = _flags()
    tb = F.col("biobank_nama").isin(*rules.TB_BIOBANKS) & (F.col("id_subject") != OTHER_SITE_SUBJECT)
    usable = flags["plasma"] | flags["whole_blood"] | flags["buffycoat"]
    grouped = rows.groupBy("id_subject").agg(
        *[F.count_if(flag).cast("bigint").alias(f"count_{n}") for n, flag in flags.items()],
        distinct_text("origin_code_repository", "; ").alias("origin_code_repository"),
        F.min(F.when(tb, F.col("biobank_nama"))).alias("_biobank"), (F.count_if(tb & usable) > 0).alias("is_tb"),
    )
    return grouped.withColumn("tb_site", F.when(F.col("is_tb"), rules.first_biobank_site("_biobank"))).drop("_biobank")


def sites(tables, biobank: DataFrame) -> DataFrame:
    """Hospital, consent and site exclusion per subject, from three disjoint sources."""
    tb = biobank.filter("is_tb").select("id_subject", F.col("tb_site").alias("hospital_name"))
    log = tables["regina_log"].filter(F.col("template_id") == DEMOGRAPHY_FORM).select("ehr_id", "logged_at", "hospital")
    log = anti_null_safe(log, tb, "ehr_id", "id_subject")
    first = latest_by(log, ["ehr_id"], [F.asc_nulls_first("logged_at")])
    from_log = first.select(
        F.col("ehr_id").alias("id_subject"), rules.hospital_from_code("hospital").alias("hospital_name"),
        F.lit(False).alias("has_tiered_digital_consent"),
        F.coalesce(F.col("hospital").isin(*rules.TB_CODES), F.lit(False)).alias("is_excluded"),
    )
    others = tables["phenovar_participants"].select("id_subject", "hospital_name")
    others = anti_null_safe(others, tb, "id_subject", "id_subject")
    # both sources have a row for each consent of the subject
    asked = others.withColumn("_tb", F.lit(False)).unionByName(tb.withColumn("_tb", F.lit(True)))
    asked = left_on(asked, tables["phenovar_digital_consent"], {"id_subject": "id_subject"}, {"id_subject": "_consent"}).select(
        "id_subject", "hospital_name", (F.col("_consent").isNotNull() & ~F.col("_tb")).alias("has_tiered_digital_consent"),
        (F.coalesce(F.col("hospital_name").isin(*rules.TB_HOSPITALS), F.lit(False)) & ~F.col("_tb")).alias("is_excluded"),
    )
    return from_log.unionByName(asked)


def biobank_types(tables) -> DataFrame:
    """Patient or control of the newest visit, per subject."""
    from strandmart.plans.staging.biobank_samples import visit_categories

    newest = visit_categories(tables, "datevisit", control=rules.CONTROL, patient=rules.PATIENT)
    return left_on(
        newest, tables["simbiox_patients"], {"px_id": "id_patient"}, ["id_subject"]
    ).filter(F.col("id_subject").isNotNull()).select("id_subject", F.col("patient_categ").alias("participant_type"))


def sequencing_states(gold_qc: DataFrame) -> DataFrame:
    """Sequenced and analysed flags, from the previous snapshot of the sample report."""
    known = gold_qc.filter(F.col("id_subject").isNotNull())
    return known.groupBy("id_subject").agg(
        (F.count("date_primary") > 0).alias("is_wgs_sequenced"),
        (F.count("date_secondary") > 0).alias("is_wgs_secondary_analysed"),
    )


def with_target(df: DataFrame, central_site: str) -> DataFrame:
    """Recruitment target of the hospital: a literal map, no join."""
    entries = [F.lit(x) for name, target in rules.TARGETS for x in (name or central_site, target)]
    return df.withColumn("hub_target", F.try_element_at(F.create_map(*entries), F.col("hospital_name")))


def run(tables, settings: Settings) -> DataFrame:
    """``tables['gold_qc']`` is the snapshot of the previous run."""
    biobank = once(tables, "biobank_subjects", biobank_subjects(specimens(tables)))
    by_subject = {"id_subject": "id_subject"}
    people, texts = subjects(tables)
    out = left_on(
        people, sites(tables, biobank), by_subject,
        {"hospital_name": "hospital_name", "has_tiered_digital_consent": "has_tiered_digital_consent",
         "is_excluded": "_site_excluded"},
    )
    out = left_on(out, biobank_types(tables), by_subject, {"participant_type": "biobank_participant_type"})
    counts = [f"count_{n}" for n in ("buffycoat", "plasma", "whole_blood", "serum", "sputum")]
    out = left_on(out, biobank, by_subject, [*counts, "origin_code_repository"])
    states = ["is_wgs_sequenced", "is_wgs_secondary_analysed"]
    out = left_on(out, sequencing_states(tables["gold_qc"]), by_subject, states)
    out = with_target(out, settings.central_site)

    no, zero = F.lit(False), F.lit(0).cast("bigint")
    out = out.select(
        "id_subject", "regina_id_subject", "phenovar_id_subject", "_duplicate", "hospital_name",
        "sex", rules.province_name("province").alias("province"), "age_at_recruitment", "creation_date",
        "registry_participant_type", "biobank_participant_type",
        rules.participant_type(
            "judul_penelitian", "registry_participant_type", "biobank_participant_type", "hospital_name",
            settings.central_site,
        ).alias("participant_type"),
        "nomor_ec", "judul_penelitian", "has_tiered_digital_consent",
        rules.exclusion("_site_excluded", "is_excluded").alias("is_excluded"),
        rules.exclusion_reason("_site_excluded", "exclusion_reason").alias("exclusion_reason"),
        title_group("judul_penelitian").alias("corrected_judul_penelitian"),
        *[F.coalesce(c, zero).alias(c) for c in counts],
        *[F.coalesce(c, no).alias(c) for c in states],
        "origin_code_repository", "hub_target",
    )
    first = latest_by(out, ["id_subject", "hospital_name", "nomor_ec"], [F.asc_nulls_first("creation_date")])
    provinces = tables["provinsi"].select(F.upper("name").alias("_name"), "iso_name")
    first = lookup(first, provinces, {"province": "_name"}, {"iso_name": "_iso"})
    first = first.withColumn("province_iso_code", rules.province_iso("_iso")).drop("_iso")
    final = with_texts(tables, first, texts)
    return final.select(*["duplicate_name_nik_id_subject" if c == "_duplicate" else c for c in first.columns])


