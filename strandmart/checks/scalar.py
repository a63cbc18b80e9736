"""Scalar functions."""

from pyspark.sql import functions as F

from strandmart.checks.registry import check, day, flag, stamp
from strandmart.functions import dates, json_text, text

# --- text -----------------------------------------------------------------


@check("regex_clean", r"""
SELECT page_id, url,
  nullif(regexp_extract(url, '^https?://([^/]+)/', 1), '') AS host,
  nullif(regexp_extract(url, '[0-9]+'), '') AS first_number,
  regexp_replace(url, '[?#].*$', '') AS bare,
  CASE WHEN url LIKE 'https%' THEN upper(nullif(regexp_extract(url, '/([a-z][a-z])/', 1), '')) ELSE lower(url) END AS lang_or_url
FROM pages
""")
def _regex(t):
    lang = F.upper(text.capture_or_null("url", "/([a-z][a-z])/"))
    return t["pages"].select(
        "page_id", "url",
        text.capture_or_null("url", "^https?://([^/]+)/").alias("host"),
        text.regexp_or_null("url", "[0-9]+").alias("first_number"),
        F.regexp_replace("url", "[?#].*$", "").alias("bare"),
        F.when(F.col("url").startswith("https"), lang).otherwise(F.lower("url")).alias("lang_or_url"),
    )


@check("test_filter", """
SELECT doc_id, lang FROM documents
WHERE NOT regexp_matches(text, '(?i)(demo|test|benchmark|dev)') AND NOT (lower(text) LIKE '%license%' OR lower(text) LIKE '%http%')
""")
def _trial(t):
    own = ~text.is_trial("text") & ~text.has_any("text", ["license", "http"])
    return t["documents"].filter(own).select("doc_id", "lang")


SAMPLE_NAMES = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE CAST(l_partkey % 6 AS INT)
    WHEN 0 THEN 'S' || CAST(l_orderkey AS STRING) || '-1-DRAGEN-4-2-6'
    WHEN 1 THEN 'S' || CAST(l_orderkey AS STRING) || '_250209_M'
    WHEN 2 THEN 'S' || CAST(l_orderkey AS STRING) || '_250209_t'
    WHEN 3 THEN 'S' || CAST(l_orderkey AS STRING) || '_250209_X'
    WHEN 4 THEN 'S' || CAST(l_orderkey AS STRING) || '_dragen_x'
    ELSE 'S' || CAST(l_orderkey AS STRING) END AS raw
FROM lineitem
"""


@check("clean_sample_id", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, raw,
  CASE WHEN raw ILIKE '%dragen%' THEN regexp_extract(raw, '[A-Za-z0-9_]+')
       WHEN raw ILIKE '%_m' OR raw ILIKE '%_t' THEN regexp_extract(raw, '[A-Za-z0-9]+') ELSE raw END AS clean
FROM ({SAMPLE_NAMES})
""")
def _clean_id(t):
    return t.sql(SAMPLE_NAMES).withColumn("clean", text.clean_sample_id("raw"))


TAG_TEXT = """
SELECT o_orderkey,
  '[''x'', ''LP' || CAST(o_custkey AS STRING) || '-P1'', ''LP9'']' AS user_tags,
  CASE CAST(o_orderkey % 3 AS INT) WHEN 0 THEN '[''a'', ''bssh.run.name:LP' || CAST(o_orderkey AS STRING) || ' '', ''b'']'
       WHEN 1 THEN '[''none'']' ELSE NULL END AS technical_tags
FROM orders
"""


@check("library_from_tags", f"""
SELECT o_orderkey, 'LP' || regexp_extract(user_tags, 'LP([0-9]+)', 1) || '-P1' AS batch,
  CASE WHEN technical_tags LIKE '%run.name%' THEN 'LP' || CAST(o_orderkey AS VARCHAR)
       ELSE 'LP' || regexp_extract(user_tags, 'LP([0-9]+)', 1) || '-P1' END AS library
FROM ({TAG_TEXT})
""")
def _library(t):
    return t.sql(TAG_TEXT).select(
        "o_orderkey", text.batch_from_user_tags("user_tags").alias("batch"),
        F.trim(text.library_from_tags("technical_tags", "user_tags")).alias("library"),
    )


@check("split_parts", """
SELECT page_id, split_part(url, '/', 3) AS host, list_extract(string_split(url, '/'), -1) AS last_part,
       CASE WHEN len(string_split(url, '/')) >= 6 THEN split_part(url, '/', 6) END AS sixth,
       trim(substr(url, 1, 12)) || '…' AS head, replace(url, 'example', 'sample') AS renamed
FROM pages
""")
def _split(t):
    return t["pages"].select(
        "page_id", text.part("url", "/", 3).alias("host"), text.part("url", "/", -1).alias("last_part"),
        text.part("url", "/", 6).alias("sixth"),
        F.concat(F.trim(F.substring("url", 1, 12)), F.lit("…")).alias("head"),
        F.replace("url", F.lit("example"), F.lit("sample")).alias("renamed"),
    )


@check("trim_quotes", """
SELECT o_orderkey, o_orderpriority AS quoted, o_orderpriority AS inner_text
FROM orders
""")
def _trim(t):
    raw = F.concat(F.lit('"'), "o_orderpriority", F.lit('"'))
    both = F.concat(F.lit(" '"), "o_orderpriority", F.lit("\" "))
    return t["orders"].select(
        "o_orderkey", text.unquote(raw).alias("quoted"), text.strip_quotes(both).alias("inner_text")
    )


MISSING = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE CAST(l_partkey % 7 AS INT) WHEN 0 THEN '' WHEN 1 THEN 'nan' WHEN 2 THEN 'NaN' WHEN 3 THEN '0000-00-00'
       WHEN 4 THEN 'x12' WHEN 5 THEN NULL ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END AS raw
FROM lineitem
"""


@check("null_text", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN raw IN ('', 'nan', 'NaN', '0000-00-00') THEN NULL ELSE raw END AS cleaned,
  nullif(raw, '') AS no_blank, CASE WHEN lower(raw) = 'nan' THEN NULL ELSE raw END AS no_nan,
  CASE WHEN lower(raw) = 'nan' THEN NULL ELSE TRY_CAST(raw AS DOUBLE) END AS number,
  CASE WHEN lower(raw) = 'nan' THEN 0 WHEN TRY_CAST(raw AS DOUBLE) >= 30 THEN 1 ELSE 0 END AS enough,
  CASE WHEN raw = '0000-00-00' THEN NULL ELSE raw END AS no_zero_date
FROM ({MISSING})
""")
def _null_text(t):
    number = text.number_or_null("raw")
    return t.sql(MISSING).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", text.clean_null("raw").alias("cleaned"),
        text.blank_to_null("raw").alias("no_blank"), text.nan_to_null("raw").alias("no_nan"), number.alias("number"),
        F.coalesce(flag(number >= 30), F.lit(0)).alias("enough"), text.zero_date_to_null("raw").alias("no_zero_date"),
    )


@check("recode", """
SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN 'FEMALE' WHEN 'O' THEN 'MALE' ELSE o_orderstatus END AS kept,
  CASE o_orderstatus WHEN 'F' THEN 'FEMALE' WHEN 'O' THEN 'MALE' END AS strict
FROM orders
""")
def _recode(t):
    words = {"F": "FEMALE", "O": "MALE"}
    return t["orders"].select(
        "o_orderkey", text.recode("o_orderstatus", words).alias("kept"),
        text.recode("o_orderstatus", words, keep_other=False).alias("strict"),
    )


@check("survey_alias", """
SELECT o_orderkey, 'SKI_' || CAST(o_custkey AS VARCHAR) AS alias FROM orders
""")
def _alias(t):
    raw = F.concat(F.lit("x-ski-SKI."), F.col("o_custkey").cast("string"), F.lit("/7"))
    return t["orders"].select("o_orderkey", F.upper(text.alias_of_survey_id(raw)).alias("alias"))


# --- dates ----------------------------------------------------------------


@check("age_years", """
SELECT o_orderkey,
  CASE WHEN date_diff('day', CAST(o_orderdate AS DATE), DATE '2000-06-30') < 0 THEN 0
       ELSE CAST(floor(date_diff('day', CAST(o_orderdate AS DATE), DATE '2000-06-30') / 365.25) AS BIGINT) END AS age,
  CAST(date_sub('year', CAST(o_orderdate AS DATE), DATE '2000-06-30') AS BIGINT) AS full_years
FROM orders
""")
def _age(t):
    at = F.lit("2000-06-30").cast("date")
    return t["orders"].select(
        "o_orderkey", dates.age_years(F.col("o_orderdate").cast("date"), at).alias("age"),
        dates.calendar_years(F.col("o_orderdate").cast("date"), at).cast("bigint").alias("full_years"),
    )


DATE_TEXT = """
SELECT o_orderkey, o_orderdate,
  CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END AS form
FROM orders
"""


@check("date_parse", """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS parsed
FROM orders
""")
def _parse(t):
    """Three sheet formats, and text that is no date."""
    form = F.col("o_orderkey") % 4
    written = (
        F.when(form == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(form == 1, F.date_format("o_orderdate", "yyMMdd"))
        .when(form == 2, F.date_format("o_orderdate", "yyMMdd; HH:mm"))
        .otherwise("soon")
    )
    parsed = dates.parse_first(written, "yyyy-MM-dd", "yyMMdd", "yyMMdd; HH:mm")
    return t["orders"].select("o_orderkey", day(parsed).alias("parsed"))


@check("day_parse", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS parsed FROM orders
""")
def _day(t):
    written = F.date_format("o_orderdate", "dd-MM-yyyy")
    raw = F.when(F.col("o_orderstatus") == "P", F.lit("31-31-2020")).otherwise(written)
    return t["orders"].select("o_orderkey", day(dates.parse_day(raw, "dd-MM-yyyy")).alias("parsed"))


@check("date_format", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, monthname(o_orderdate) AS m,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS full_text, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso
FROM orders
""")
def _format(t):
    return t["orders"].select(
        "o_orderkey", F.year("o_orderdate").alias("y"), dates.month_name("o_orderdate").alias("m"),
        stamp("o_orderdate").alias("full_text"), dates.iso_text("o_orderdate").alias("iso"),
    )


@check("nanos_parse", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS parsed FROM events
""")
def _nanos(t):
    written = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("9Z"))
    parsed = dates.parse_nanos(written)
    return t["events"].select("event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("parsed"))


@check("birth_century", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '1976-05-19' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS born FROM orders
""")
def _century(t):
    raw = F.when(F.col("o_orderstatus") == "P", F.lit("0976-05-19")).otherwise(day("o_orderdate"))
    return t["orders"].select("o_orderkey", day(dates.fix_birth_century(raw)).alias("born"))


# --- JSON and arrays ------------------------------------------------------


@check("json_path", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       event_type || '/' || CAST(user_id AS VARCHAR) || ':0|v' AS nested
FROM events
""")
def _json_path(t):
    composed = F.concat(
        F.lit('{"composition": {"form/x:0|value": "'), "event_type", F.lit("/"), F.col("user_id").cast("string"),
        F.lit(':0|v"}}'),
    )
    nested = json_text.json_fields(composed, "composition struct<`form/x:0|value`: string>")
    k = json_text.json_fields("props", "k int")
    return t["events"].select(
        "event_id", k["k"].alias("k"), nested["composition"]["form/x:0|value"].alias("nested")
    )


@check("json_array", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS newest, 3 AS entries FROM orders
""")
def _json_array(t):
    """Newest time of a list kept as Python-literal text; the bad entry is ignored."""
    earlier = F.col("o_orderdate") - F.expr("INTERVAL 3 DAY")
    written = F.concat(F.lit("['soon', '"), stamp(earlier), F.lit("', '"), stamp("o_orderdate"), F.lit("']"))
    return t["orders"].select(
        "o_orderkey", stamp(json_text.newest_of_list(written)).alias("newest"), F.size(json_text.text_list(written)).alias("entries")
    )


@check("json_explode", """
SELECT o_orderkey, unnest(string_split(o_orderpriority, '-')) AS word FROM orders
""")
def _json_explode(t):
    written = F.concat(F.lit("['"), F.replace("o_orderpriority", F.lit("-"), F.lit("', '")), F.lit("']"))
    return t["orders"].select("o_orderkey", F.explode(json_text.text_list(written)).alias("word"))


LITERALS = """
SELECT o_orderkey, o_custkey, CASE CAST(o_orderkey % 5 AS INT)
  WHEN 0 THEN '{"a": ' || CAST(o_custkey AS STRING) || '}'
  WHEN 1 THEN '{''a'': ' || CAST(o_custkey AS STRING) || ', ''b'': None}'
  WHEN 2 THEN 'plain ' || CAST(o_custkey AS STRING)
  WHEN 3 THEN NULL
  ELSE '[True, ' || CAST(o_custkey AS STRING) || ']' END AS raw
FROM orders
"""


@check("valid_json", f"""
SELECT o_orderkey, CASE CAST(o_orderkey % 5 AS INT)
  WHEN 0 THEN raw WHEN 1 THEN '{{"a": ' || CAST(o_custkey AS VARCHAR) || ', "b": null}}'
  WHEN 2 THEN '"' || raw || '"' WHEN 3 THEN 'null' ELSE '[true, ' || CAST(o_custkey AS VARCHAR) || ']' END AS json
FROM ({LITERALS})
""")
def _valid_json(t):
    return t.sql(LITERALS).select("o_orderkey", json_text.to_valid_json("raw").alias("json"))


@check("array_math", """
SELECT vec_id, round(list_sum(embedding), 3) AS total, round(CAST(embedding[1] AS DOUBLE), 4) AS first_value,
       CAST(floor(label / 3) AS BIGINT) AS third, round(100.0 * label / nullif(label, 0), 2) AS percent
FROM embeddings
""")
def _array(t):
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return t["embeddings"].select(
        "vec_id", F.round(total, 3).alias("total"),
        F.round(F.try_element_at("embedding", F.lit(1)).cast("double"), 4).alias("first_value"),
        F.floor(F.col("label") / 3).alias("third"),
        F.round(F.try_divide(100.0 * F.col("label"), F.col("label")), 2).alias("percent"),
    )


@check("blank_sums", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  l_partkey + CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(floor(l_quantity) AS BIGINT) END AS total
FROM lineitem
""")
def _blank(t):
    """Sum over a text list in which blanks and missing entries count nothing."""
    amount = F.when(F.col("l_returnflag") == "R", "").otherwise(F.col("l_quantity").cast("string"))
    amounts = F.array(F.col("l_partkey").cast("string"), amount, F.lit(None), F.lit("nan"))
    return t["lineitem"].select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", json_text.sum_ignoring_blanks(amounts).alias("total")
    )
