"""Phenotype of each reported subject for 30 gene-drug pairs."""

from pyspark.sql import functions as F

from strandmart.functions.rules import dose_text
from strandmart.operators.joins import left_on, lookup, pairs_with_default
from strandmart.operators.ranking import latest_by

# Fixed values: (gene, drug name in the reports, drug class where it matters), in report order.
# Two Phenytoin rows have drug label and gene crossed, as in the report in use.
PAIRS = [
    ("NAT2", "Isoniazid", "Antituberculosis"),
    ("MTRNR1", "Amikacin", None),
    ("CYP2D6", "Amitriptyline || CYP2D6", None),
    ("CYP2C19", "Amitriptyline || CYP2C19", None),
    ("NUDT15", "Azathioprine || NUDT15", None),
    ("TPMT", "Azathioprine || TPMT", None),
    ("DPYD", "Capecitabine", None),
    ("CYP2C9", "Celecoxib", None),
    ("CYP2C19", "Clopidogrel", None),
    ("CYP2D6", "Codeine || CYP2D6", None),
    ("G6PD", "Dapsone", None),
    ("CACNA1S;RYR1", "Desflurane", None),
    ("CYP2B6", "Efavirenz", None),
    ("DPYD", "Fluorouracil", None),
    ("MTRNR1", "Gentamicin", None),
    ("UGT1A1", "Irinotecan", None),
    ("CACNA1S;RYR1", "Isoflurane", None),
    ("NUDT15", "Mercaptopurine || NUDT15", None),
    ("TPMT", "Mercaptopurine || TPMT", None),
    ("CYP2C19", "Phenytoin || CYP2C9", None),
    ("CYP2C9", "Phenytoin || CYP2C19", None),
    ("G6PD", "Primaquine", None),
    ("SLCO1B1", "Rosuvastatin || SLCO1B1", None),
    ("ABCG2", "Rosuvastatin || ABCG2", None),
    ("CACNA1S;RYR1", "Sevoflurane", None),
    ("MTRNR1", "Streptomycin", None),
    ("CYP2D6", "Tamoxifen", None),
    ("CYP2D6", "Tramadol || CYP2D6", None),
    ("CYP2C19", "Voriconazole || CYP2C19", None),
    ("VKORC1;CYP2C9;CY", "Warfarin", None),
]
UNKNOWN = " Tidak Dapat Ditentukan"


def numbered_pairs(details):
    """Details of the listed pairs, with the number of the pair.

    The list is a literal table of 30 rows, so its broadcast has a fixed size.
    """
    entries = [
        F.struct(
            F.lit(i).alias("pair"), F.lit(g.lower()).alias("_gene"), F.lit(d.lower()).alias("_drug"),
            F.lit(c and c.lower()).cast("string").alias("_class"),
        )
        for i, (g, d, c) in enumerate(PAIRS)
    ]
    pairs = details.sparkSession.range(1).select(F.inline(F.array(*entries)))
    same = (F.lower("gene_symbol") == F.col("_gene")) & (F.lower("drug_name") == F.col("_drug"))
    allowed = F.col("_class").isNull() | (F.lower("drug_classification") == F.col("_class"))
    return details.join(F.broadcast(pairs), same & allowed).drop("_gene", "_drug", "_class")


def subjects(tables):
    """Newest local report per subject that has any report."""
    reported = tables["gold_pgx_report"].filter(
        F.col("ind_report_creation_date").isNotNull() | F.col("eng_report_creation_date").isNotNull()
    ).select("id_subject", "file_name", "ind_report_creation_date")
    return latest_by(reported, ["id_subject"], ["ind_report_creation_date"]).drop("ind_report_creation_date")


def places(tables):
    """Subjects with their provinces and hospitals, each pair once."""
    people = tables["staging_demography"].select("id_subject", "province", "hospital_name")
    by_subject = {"id_subject": "id_subject"}
    out = left_on(subjects(tables), people.select("id_subject", "province").distinct(), by_subject, ["province"])
    out = left_on(out, people.select("id_subject", "hospital_name").distinct(), by_subject, ["hospital_name"])
    names = tables["provinsi"].select(F.upper("name").alias("_name"), "iso_name").distinct()
    return lookup(out, names, {"province": "_name"}, ["iso_name"])


def findings(tables):
    """Distinct findings per report and pair."""
    details = tables["gold_pgx_detail_report"].filter(F.col("phenotype_text").isNotNull()).select(
        "order_id", "drug_classification", "phenotype_text", "gene_symbol", "rec_category", "drug_name"
    )
    return numbered_pairs(details).select(
        "order_id", "pair", "phenotype_text", "gene_symbol", dose_text("rec_category").alias("recommendation"), "drug_name"
    ).distinct()


def run(tables):
    """All joins are at subject or report level; the pairs are made last, without a further shuffle."""
    take = ["phenotype_text", "gene_symbol", "recommendation", "drug_name"]
    rows = pairs_with_default(places(tables), findings(tables), "file_name", "order_id", len(PAIRS), take)
    pair = F.col("pair") + 1
    gene = F.coalesce("gene_symbol", F.element_at(F.array(*[F.lit(g) for g, _, _ in PAIRS]), pair))
    drug = F.coalesce("drug_name", F.element_at(F.array(*[F.lit(d) for _, d, _ in PAIRS]), pair))
    return rows.select(
        "id_subject", "province", "iso_name",
        F.coalesce("phenotype_text", F.concat(gene, F.lit(UNKNOWN))).alias("phenotype_text"),
        gene.alias("gene_symbol"), "recommendation", drug.alias("drug_name"),
        F.concat(gene, F.lit(" - "), drug).alias("gene_drug"), "hospital_name",
    )
