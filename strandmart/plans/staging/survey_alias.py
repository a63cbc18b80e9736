"""Alias map of survey origin codes."""

from pyspark.sql import functions as F

from strandmart.functions.text import alias_of_survey_id


def run(tables):
    samples = tables["simbiox_biosamples"].filter(F.col("origin_code_repository").ilike("%SKI%"))
    return samples.select(
        "code_repository",
        "origin_code_repository",
        alias_of_survey_id("origin_code_repository").alias("new_origin_code_repository"),
    )
