"""Relational operators."""

from pyspark.sql import functions as F

from strandmart.checks.registry import cents, check, day, flag, stamp
from strandmart.functions import qc_rules
from strandmart.functions.json_text import list_to_json
from strandmart.operators import (
    anti_null_safe,
    anti_on,
    best_by,
    coalesce_sources,
    collect_parallel,
    concat_distinct,
    concat_sorted,
    count_by,
    dense_rank_by,
    first_flag,
    flag_counts,
    flagged_keys,
    group_totals,
    insert_absent,
    latest_by,
    left_on,
    lookup,
    map_latest,
    melt,
    or_join,
    override,
    pairs_with_default,
    pivot_first,
    pivot_latest,
    prefix_join,
    richest_by,
    semi_on,
    top_n_by,
    union_by_name,
    union_padded,
    upsert,
)

# --- ranks ----------------------------------------------------------------


@check("latest_by", """
SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
""")
def _latest(t):
    newest = latest_by(t["events"], ["user_id"], ["ts", "event_id"])
    return newest.select("user_id", "event_id", stamp("ts").alias("ts"), "event_type", "value")


@check("best_by", """
SELECT l_partkey, l_orderkey, l_linenumber, l_extendedprice
FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey
        ORDER BY l_extendedprice DESC, l_orderkey DESC, l_linenumber DESC) AS rn FROM lineitem)
WHERE rn = 1
""")
def _best(t):
    lines = t["lineitem"].select("l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    return best_by(lines, ["l_partkey"], "l_extendedprice", ["l_orderkey", "l_linenumber"])


@check("latest_by_kind", """
SELECT user_id, event_type, event_id, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
""")
def _latest_kind(t):
    rows = t["events"].select("user_id", "event_type", "event_id", "value", "ts")
    return latest_by(rows, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@check("top_n_by", """
SELECT o_custkey, o_orderkey, o_totalprice
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
WHERE rn <= 3
""")
def _top_n(t):
    rows = t["orders"].select("o_custkey", "o_orderkey", "o_totalprice")
    return top_n_by(rows, ["o_custkey"], ["o_totalprice"], 3)


@check("dense_rank", """
SELECT o_orderkey, o_custkey,
       dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS date_rank
FROM orders
""")
def _dense(t):
    rows = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    ranked = dense_rank_by(rows, ["o_custkey"], "o_orderdate", "date_rank")
    return ranked.select("o_orderkey", "o_custkey", F.col("date_rank").cast("bigint").alias("date_rank"))


@check("dense_rank_dup", """
SELECT o_orderkey, o_custkey,
       CASE WHEN dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) = 1 THEN o_orderpriority END AS priority_non_dup
FROM orders
""")
def _dense_dup(t):
    rows = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    firsts = rows.groupBy("o_custkey").agg(F.min(F.struct("o_orderdate")).alias("first"))
    rows = left_on(rows, firsts, {"o_custkey": "o_custkey"}, ["first"])
    kept = F.when(F.struct("o_orderdate") == F.col("first"), F.col("o_orderpriority"))
    return rows.select("o_orderkey", "o_custkey", kept.alias("priority_non_dup"))


@check("first_flag", """
SELECT l_partkey, l_returnflag, l_quantity,
       CASE WHEN row_number() OVER (PARTITION BY l_partkey, l_returnflag ORDER BY l_quantity) > 1 THEN 'Duplicate' END AS mark
FROM lineitem
""")
def _first_flag(t):
    rows = t["lineitem"].select("l_partkey", "l_returnflag", "l_quantity")
    flagged = first_flag(rows, ["l_partkey", "l_returnflag"], ["l_quantity"])
    return flagged.select("l_partkey", "l_returnflag", "l_quantity", F.when(~F.col("is_first"), "Duplicate").alias("mark"))


@check("richest_by", """
SELECT o_custkey, o_orderkey, a, b FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY
      (CASE WHEN a IS NULL THEN 0 ELSE 1 END) + (CASE WHEN b IS NULL THEN 0 ELSE 1 END) DESC,
      o_orderkey) AS rn
  FROM (SELECT o_custkey, o_orderkey, nullif(o_orderstatus, 'O') AS a, nullif(o_orderpriority, '5-LOW') AS b FROM orders))
WHERE rn = 1
""")
def _richest(t):
    rows = t["orders"].select(
        "o_custkey", "o_orderkey", F.nullif("o_orderstatus", F.lit("O")).alias("a"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("b"),
    )
    return richest_by(rows, ["o_custkey"])


@check("two_rank_orders", """
SELECT a.user_id, a.event_id AS newest_event, b.event_id AS largest_event
FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events) a
JOIN (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn FROM events) b
  ON a.user_id = b.user_id
WHERE a.rn = 1 AND b.rn = 1
""")
def _two_orders(t):
    """Two choices per key in one aggregation instead of two windows."""
    def first(order):
        negative_id = -F.col("event_id")
        return F.max(F.struct(F.col(order), negative_id.alias("n"), F.col("event_id")))["event_id"]

    return t["events"].groupBy("user_id").agg(first("ts").alias("newest_event"), first("value").alias("largest_event"))


# --- aggregates -----------------------------------------------------------


@check("global_count", "SELECT count(*) AS ct FROM orders")
def _global(t):
    return t["orders"].agg(F.count(F.lit(1)).alias("ct"))


@check("flag_window_sum", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN m > 2 THEN 'Fail' WHEN m = 2 AND n = 0 THEN 'Pass' WHEN m = 1 AND n < 2 THEN 'Pass'
       WHEN m = 0 AND n < 3 THEN 'Pass' ELSE 'Incomplete Data' END AS batch_class
FROM (SELECT *,
        sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey) AS m,
        sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey) AS n
      FROM lineitem)
""")
def _flag_window(t):
    rows = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    totals = {"m": F.count_if(F.col("l_returnflag") == "R"), "n": F.count_if(F.col("l_returnflag") == "A")}
    counted = group_totals(rows, ["l_orderkey"], totals)
    return counted.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", qc_rules.batch_category("m", "n").alias("batch_class")
    )


KINDS = ("click", "error", "purchase", "signup", "view")


@check("pivot_latest", """
SELECT user_id,
  max(CASE WHEN event_type = 'click' THEN value END) AS click_value,
  max(CASE WHEN event_type = 'error' THEN value END) AS error_value,
  max(CASE WHEN event_type = 'purchase' THEN value END) AS purchase_value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1 AND event_type IN ('click', 'error', 'purchase')
GROUP BY user_id
""")
def _pivot_latest(t):
    kinds = ("click", "error", "purchase")
    rows = t["events"].withColumns({f"{k}_value": F.col("value") for k in kinds})
    return pivot_latest(rows, ["user_id"], "event_type", {k: [f"{k}_value"] for k in kinds}, ["ts", "event_id"])


@check("pivot_first", """
SELECT l_orderkey,
  max(CASE WHEN l_returnflag = 'A' THEN l_partkey END) AS a_part, max(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS a_quantity,
  max(CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS r_part, max(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS r_quantity
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey, l_quantity) AS rn FROM lineitem)
WHERE rn = 1
GROUP BY l_orderkey
""")
def _pivot_first(t):
    return pivot_first(
        t["lineitem"], ["l_orderkey"], F.col("l_returnflag"), {"A": "a", "R": "r"},
        {"l_partkey": "_part", "l_quantity": "_quantity"}, ["l_linenumber", "l_partkey", "l_quantity"],
    )


@check("flag_counts", """
SELECT user_id, """ + ", ".join(
    f"count(*) FILTER (event_type = '{k}') AS count_{k}, "
    f"CASE WHEN count(*) FILTER (event_type = '{k}') > 0 THEN 1 ELSE 0 END AS is_{k}" for k in KINDS
) + " FROM events GROUP BY user_id")
def _flag_counts(t):
    counts = flag_counts(t["events"], ["user_id"], {k: F.col("event_type") == k for k in KINDS})
    return flagged_keys(counts, KINDS)


@check("concat_distinct", """
SELECT o_custkey,
  string_agg(DISTINCT o_orderpriority, '; ' ORDER BY o_orderpriority) AS priorities,
  string_agg(DISTINCT o_orderstatus, '; ' ORDER BY o_orderstatus) AS statuses
FROM orders GROUP BY o_custkey
""")
def _concat_distinct(t):
    names = {"o_orderpriority": "priorities", "o_orderstatus": "statuses"}
    return concat_distinct(t["orders"], ["o_custkey"], names, "; ")


@check("concat_sorted", """
SELECT c_nationkey, c_mktsegment, string_agg(c_name, ',' ORDER BY c_name) AS names
FROM customer GROUP BY c_nationkey, c_mktsegment
""")
def _concat_sorted(t):
    return concat_sorted(t["customer"], ["c_nationkey", "c_mktsegment"], "c_name", ",", "names")


@check("distinct_count_having", """
SELECT o_custkey, count(DISTINCT o_orderstatus) AS n_status, count(*) AS ct
FROM orders GROUP BY o_custkey HAVING n_status > 1
""")
def _having(t):
    counted = t["orders"].groupBy("o_custkey").agg(
        F.count_distinct("o_orderstatus").alias("n_status"), F.count(F.lit(1)).alias("ct")
    )
    return counted.filter("n_status > 1")


@check("group_expr", """
SELECT nullif(l_returnflag, 'N') AS flag, l_linestatus, count(*) AS ct, round(sum(l_quantity), 2) AS quantity
FROM lineitem GROUP BY 1, 2
""")
def _group_expr(t):
    key = F.nullif("l_returnflag", F.lit("N")).alias("flag")
    return t["lineitem"].groupBy(key, "l_linestatus").agg(
        F.count(F.lit(1)).alias("ct"), cents(F.sum("l_quantity")).alias("quantity")
    )


@check("count_by", """
SELECT lang, source, count(*) AS ct FROM documents GROUP BY lang, source
""")
def _count_by(t):
    return count_by(t["documents"], ["lang", "source"])


@check("loose_group", """
SELECT o_custkey, o_orderstatus, count(*) AS ct, min(o_orderkey) AS first_order,
       arg_min(o_orderpriority, o_orderkey) AS first_priority
FROM orders GROUP BY o_custkey, o_orderstatus
""")
def _loose(t):
    """Ungrouped columns come from the row with the smallest id."""
    return t["orders"].groupBy("o_custkey", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("ct"), F.min("o_orderkey").alias("first_order"),
        F.min_by("o_orderpriority", "o_orderkey").alias("first_priority"),
    )


@check("collect_parallel", """
SELECT l_orderkey,
  '[' || string_agg('"' || CAST(CAST(l_partkey AS BIGINT) AS VARCHAR) || '"', ',' ORDER BY l_linenumber, l_partkey, l_suppkey, CAST(CAST(nullif(l_quantity, 1) AS BIGINT) AS VARCHAR) NULLS FIRST) || ']' AS parts,
  '[' || string_agg('"' || coalesce(CAST(CAST(nullif(l_quantity, 1) AS BIGINT) AS VARCHAR), '') || '"', ',' ORDER BY l_linenumber, l_partkey, l_suppkey, CAST(CAST(nullif(l_quantity, 1) AS BIGINT) AS VARCHAR) NULLS FIRST) || ']' AS quantities,
  CAST(sum(coalesce(CAST(nullif(l_quantity, 1) AS BIGINT), 0)) AS BIGINT) AS total
FROM lineitem GROUP BY l_orderkey
""")
def _collect(t):
    from strandmart.functions.json_text import sum_ignoring_blanks

    rows = t["lineitem"].select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_partkey").cast("string").alias("parts"),
        F.nullif("l_quantity", F.lit(1.0)).cast("bigint").cast("string").alias("quantities"),
    )
    lists = collect_parallel(
        rows, ["l_orderkey"], ["parts", "quantities"], ["l_linenumber", "l_partkey", "l_suppkey"]
    )
    return lists.select(
        "l_orderkey", list_to_json("parts").alias("parts"), list_to_json("quantities").alias("quantities"),
        sum_ignoring_blanks("quantities").alias("total"),
    )


@check("agg_before_join", """
SELECT o_orderkey, o_orderstatus, n_lines, quantity
FROM orders LEFT JOIN (
  SELECT l_orderkey, count(*) AS n_lines, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY l_orderkey
) ON o_orderkey = l_orderkey
""")
def _agg_join(t):
    sums = t["lineitem"].groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), cents(F.sum("l_quantity")).alias("quantity")
    )
    return left_on(
        t["orders"].select("o_orderkey", "o_orderstatus"), sums, {"o_orderkey": "l_orderkey"}, ["n_lines", "quantity"]
    )


# --- joins ----------------------------------------------------------------


@check("lookup_join", """
SELECT s_suppkey, s_name, n1.n_name AS own_nation, n2.n_name AS next_nation, r_name
FROM supplier
LEFT JOIN nation n1 ON s_nationkey = n1.n_nationkey
LEFT JOIN nation n2 ON s_nationkey + 1 = n2.n_nationkey
LEFT JOIN region ON n1.n_regionkey = r_regionkey
""")
def _lookup(t):
    facts = t["supplier"].select("s_suppkey", "s_name", "s_nationkey", (F.col("s_nationkey") + 1).alias("next"))
    out = lookup(facts, t["nation"], {"s_nationkey": "n_nationkey"}, {"n_name": "own_nation", "n_regionkey": "region"})
    out = lookup(out, t["nation"], {"next": "n_nationkey"}, {"n_name": "next_nation"})
    out = lookup(out, t["region"], {"region": "r_regionkey"}, ["r_name"])
    return out.select("s_suppkey", "s_name", "own_nation", "next_nation", "r_name")


@check("inner_join", """
SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey
""")
def _inner(t):
    return t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_name", "c_mktsegment"
    )


def _newest_lines(column):
    return f"""(SELECT * FROM (SELECT l_orderkey, l_partkey, l_quantity,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_partkey, l_quantity) AS rn
        FROM lineitem WHERE l_returnflag = '{column}') WHERE rn = 1)"""


@check("platform_coalesce", f"""
SELECT o_orderkey, coalesce(a.l_partkey, n.l_partkey, r.l_partkey) AS l_partkey,
       coalesce(a.l_quantity, n.l_quantity, r.l_quantity) AS l_quantity
FROM orders
LEFT JOIN {_newest_lines("A")} a ON o_orderkey = a.l_orderkey AND o_orderstatus = 'O'
LEFT JOIN {_newest_lines("N")} n ON o_orderkey = n.l_orderkey AND o_orderstatus = 'F'
LEFT JOIN {_newest_lines("R")} r ON o_orderkey = r.l_orderkey AND o_orderstatus = 'P'
""")
def _platform(t):
    lines = t["lineitem"].select(
        F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_quantity", "l_shipdate", "l_returnflag"
    )
    sources = [
        (latest_by(lines.filter(F.col("l_returnflag") == f), ["o_orderkey"], ["l_shipdate"]), F.col("o_orderstatus") == s)
        for f, s in (("A", "O"), ("N", "F"), ("R", "P"))
    ]
    base = t["orders"].select("o_orderkey", "o_orderstatus")
    return coalesce_sources(base, sources, "o_orderkey", ["l_partkey", "l_quantity"]).drop("o_orderstatus")


@check("semi_in", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def _semi(t):
    pending = t["orders"].filter(F.col("o_orderstatus") == "P")
    return semi_on(t["customer"].select("c_custkey", "c_name"), pending, "c_custkey", "o_custkey")


@check("anti_join", """
SELECT c_custkey, c_name FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderpriority = '1-URGENT'
WHERE o_custkey IS NULL
""")
def _anti(t):
    urgent = t["orders"].filter(F.col("o_orderpriority") == "1-URGENT")
    return anti_on(t["customer"].select("c_custkey", "c_name"), urgent, "c_custkey", "o_custkey")


@check("anti_null", """
SELECT user_id, event_id FROM (SELECT event_id, nullif(user_id, 3) AS user_id FROM events)
WHERE user_id NOT IN (SELECT k FROM (SELECT nullif(c_custkey, 5) AS k FROM customer WHERE c_mktsegment <> 'BUILDING') WHERE k IS NOT NULL)
""")
def _anti_null(t):
    rows = t["events"].select("event_id", F.nullif("user_id", F.lit(3)).alias("user_id"))
    ids = t["customer"].filter(F.col("c_mktsegment") != "BUILDING").select(
        F.nullif("c_custkey", F.lit(5)).alias("k")
    )
    return anti_null_safe(rows, ids, "user_id", "k").select("user_id", "event_id")


@check("or_join", """
SELECT DISTINCT o_orderkey, o_custkey, s_name
FROM (SELECT o_orderkey, o_custkey, o_custkey % 40 AS k1, o_orderkey % 90 AS k2 FROM orders)
LEFT JOIN supplier ON k1 = s_suppkey OR k2 = s_suppkey
""")
def _or(t):
    rows = t["orders"].select(
        "o_orderkey", "o_custkey", (F.col("o_custkey") % 40).alias("k1"), (F.col("o_orderkey") % 90).alias("k2")
    )
    out = or_join(rows, t["supplier"], ["k1", "k2"], "s_suppkey", ["s_name"], ["o_orderkey"])
    return out.select("o_orderkey", "o_custkey", "s_name").distinct()


@check("mapping_join", """
SELECT doc_id, coalesce(new_source, source) AS source
FROM documents LEFT JOIN (
  SELECT k_doc, k_source, new_source FROM (
    SELECT d.doc_id AS k_doc, d.source AS k_source, d.source || '-' || CAST(l.quality AS VARCHAR) AS new_source,
           row_number() OVER (PARTITION BY d.doc_id, d.source ORDER BY l.toxic DESC, l.quality DESC) AS rn
    FROM labels l JOIN documents d ON d.doc_id = l.doc_id)
  WHERE rn = 1
) ON CAST(doc_id AS VARCHAR) = CAST(k_doc AS VARCHAR) AND trim(source) = trim(k_source)
""")
def _mapping(t):
    documents = t["documents"].select("doc_id", "source")
    fixes = t["labels"].join(documents, "doc_id").select(
        "doc_id", "source", F.concat("source", F.lit("-"), F.col("quality").cast("string")).alias("new_source"), "toxic"
    )
    return map_latest(documents, fixes, ["doc_id", "source"], "source", "new_source", ["toxic"])


@check("override_join", """
SELECT o_orderkey, coalesce(fixed, o_orderstatus) AS o_orderstatus
FROM orders LEFT JOIN (SELECT l_orderkey, max(l_linestatus) AS fixed FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
ON o_orderkey = l_orderkey
""")
def _override(t):
    fixes = t["lineitem"].filter(F.col("l_returnflag") == "R").groupBy("l_orderkey").agg(
        F.max("l_linestatus").alias("fixed")
    )
    rows = t["orders"].select("o_orderkey", "o_orderstatus")
    return override(rows.withColumnRenamed("o_orderkey", "l_orderkey"), fixes, "l_orderkey", "o_orderstatus", "fixed") \
        .withColumnRenamed("l_orderkey", "o_orderkey")


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@check("pair_default", """
SELECT c_custkey, p.priority, coalesce(o_orderstatus, 'none') AS status
FROM customer
CROSS JOIN (VALUES """ + ", ".join(f"('{p}')" for p in PRIORITIES) + """) p(priority)
LEFT JOIN (SELECT DISTINCT o_custkey, o_orderpriority, o_orderstatus FROM orders)
  ON c_custkey = o_custkey AND o_orderpriority = p.priority
""")
def _pairs(t):
    numbers = F.create_map(*[F.lit(x) for i, p in enumerate(PRIORITIES) for x in (p, i)])
    facts = t["orders"].select("o_custkey", "o_orderpriority", "o_orderstatus").distinct()
    facts = facts.withColumn("pair", F.try_element_at(numbers, F.col("o_orderpriority"))).filter("pair IS NOT NULL")
    rows = pairs_with_default(
        t["customer"].select("c_custkey"), facts, "c_custkey", "o_custkey", len(PRIORITIES), ["o_orderstatus"]
    )
    name = F.element_at(F.array(*[F.lit(p) for p in PRIORITIES]), F.col("pair") + 1)
    return rows.select("c_custkey", name.alias("priority"), F.coalesce("o_orderstatus", F.lit("none")).alias("status"))


@check("prefix_join", """
SELECT DISTINCT n_name, c_name
FROM (SELECT n_name || '/' AS prefix, n_name FROM nation)
JOIN (SELECT 'NATION_' || CAST(c_nationkey AS VARCHAR) || '/' || c_name AS folder, c_name FROM customer)
  ON starts_with(folder, prefix)
""")
def _prefix(t):
    ids = t["nation"].select(F.concat("n_name", F.lit("/")).alias("prefix"), "n_name")
    folders = t["customer"].select(
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"), F.lit("/"), "c_name").alias("folder"), "c_name"
    )
    return prefix_join(ids, folders, "prefix", "folder").select("n_name", "c_name").distinct()


@check("function_key_join", """
SELECT c_custkey, n_regionkey FROM customer
LEFT JOIN nation ON 'nation_' || CAST(c_nationkey AS VARCHAR) = lower(n_name)
""")
def _function_key(t):
    names = t["nation"].select(F.lower("n_name").alias("name"), "n_regionkey")
    rows = t["customer"].select(
        "c_custkey", F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("name")
    )
    return left_on(rows, names, {"name": "name"}, ["n_regionkey"]).drop("name")


# --- unions and un-pivot --------------------------------------------------


@check("union_padded", """
SELECT 'c' AS kind, c_custkey AS id, c_name AS name, c_acctbal AS balance, CAST(NULL AS VARCHAR) AS brand FROM customer
UNION ALL SELECT 's', s_suppkey, s_name, s_acctbal, NULL FROM supplier
UNION ALL SELECT 'p', p_partkey, p_name, NULL, p_brand FROM part
""")
def _union(t):
    schema = {"kind": "string", "id": "bigint", "name": "string", "balance": "double", "brand": "string"}
    return union_padded(
        [
            t["customer"].select(F.lit("c").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")),
            t["supplier"].select(F.lit("s").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")),
            t["part"].select(F.lit("p").alias("kind"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand")),
        ],
        schema,
    )


@check("concat_by_name", """
SELECT doc_id, lang, CAST(NULL AS INTEGER) AS quality FROM documents
UNION ALL SELECT doc_id, NULL, quality FROM labels
""")
def _concat(t):
    return union_by_name([t["documents"].select("doc_id", "lang"), t["labels"].select("quality", "doc_id")])


@check("unpivot", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, measure, amount FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'l_quantity' AS measure, l_quantity AS amount FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'l_extendedprice', l_extendedprice FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'l_discount', l_discount FROM lineitem)
""")
def _unpivot(t):
    ids = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return melt(t["lineitem"], ids, ["l_quantity", "l_extendedprice", "l_discount"], "measure", "amount")


@check("inline_table", """
SELECT c_custkey, c_mktsegment, target FROM customer
LEFT JOIN (VALUES ('BUILDING', 2468), ('MACHINERY', 1500), ('HOUSEHOLD', 3800)) v(name, target) ON c_mktsegment = name
""")
def _inline(t):
    """A literal table is a map literal: no join at all."""
    targets = F.create_map(*[F.lit(x) for x in ("BUILDING", 2468, "MACHINERY", 1500, "HOUSEHOLD", 3800)])
    return t["customer"].select(
        "c_custkey", "c_mktsegment", F.try_element_at(targets, F.col("c_mktsegment")).alias("target")
    )


@check("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_discount FROM lineitem")
def _distinct(t):
    return t["lineitem"].select("l_returnflag", "l_linestatus", "l_discount").distinct()


@check("shared_step", """
WITH totals AS (SELECT o_custkey, count(*) AS ct FROM orders GROUP BY o_custkey)
SELECT t.o_custkey, t.ct, CASE WHEN t.ct > a.mean_ct THEN 1 ELSE 0 END AS above_mean
FROM totals t, (SELECT avg(ct) AS mean_ct FROM totals) a
""")
def _shared(t):
    """A named step used twice; the one-row average is a scalar subquery."""
    totals = count_by(t["orders"], ["o_custkey"])
    mean = totals.agg(F.avg("ct").alias("mean_ct"))
    return totals.select("o_custkey", "ct", flag(F.col("ct") > mean.scalar()).alias("above_mean"))


@check("ordered_top", """
SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate
FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100
""")
def _ordered(t):
    rows = t["orders"].orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)
    return rows.select("o_orderkey", "o_totalprice", day("o_orderdate").alias("o_orderdate"))


@check("predicate_column", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN (l_discount = 0 OR l_discount IS NULL) AND l_tax > 0.04 THEN 1 ELSE 0 END AS full_price
FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_linestatus <> 'F' AND l_quantity >= 10
""")
def _predicate(t):
    rows = t["lineitem"].filter(
        F.col("l_returnflag").isin("A", "R") & (F.col("l_linestatus") != "F") & (F.col("l_quantity") >= 10)
    )
    full = F.coalesce(F.col("l_discount"), F.lit(0.0)).eqNullSafe(0.0) & (F.col("l_tax") > 0.04)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", flag(full).alias("full_price"))


# --- upserts --------------------------------------------------------------

TARGET = "SELECT o_orderkey AS id, o_custkey AS owner, o_orderstatus AS status, o_totalprice AS price, 'old' AS origin, 1 AS updated_at FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00'"
BATCH = """SELECT o_orderkey AS id, o_custkey AS owner, lower(o_orderstatus) AS status, o_totalprice + k AS price, 'new' AS origin, 2 AS updated_at, k
FROM orders CROSS JOIN (SELECT 1 AS k UNION ALL SELECT 2 AS k) WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'"""
MERGED = f"""
WITH target AS ({TARGET}), batch AS ({BATCH}),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY k DESC) AS rn FROM batch) WHERE rn = 1)
SELECT coalesce(t.id, s.id) AS id, coalesce(s.owner, t.owner) AS owner, coalesce(s.status, t.status) AS status,
       round(coalesce(s.price, t.price), 2) AS price, coalesce(t.origin, s.origin) AS origin,
       CASE WHEN t.id IS NULL THEN s.updated_at WHEN s.id IS NULL THEN t.updated_at ELSE {{stamp}} END AS updated_at
FROM target t FULL JOIN last s ON t.id = s.id
"""


def _batch(t):
    orders = t["orders"].filter(F.col("o_orderdate") >= "1997-01-01")
    return orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("owner"), F.lower("o_orderstatus").alias("status"),
        "o_totalprice", F.lit("new").alias("origin"), F.lit(2).alias("updated_at"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("k"),
    ).withColumn("price", F.col("o_totalprice") + F.col("k")).drop("o_totalprice")


def _upserted(t, keep, stamp_column):
    out = upsert(t.sql(TARGET), _batch(t), ["id"], keep, ["k"], stamp_column)
    return out.withColumn("price", cents("price"))


@check("upsert", MERGED.format(stamp="3"))
def _upsert_run(t):
    """Last row of the batch wins, ``origin`` is insert-only, the stamp is the run time."""
    return _upserted(t, ["origin"], ("updated_at", F.lit(3)))


@check("upsert_incoming", MERGED.format(stamp="s.updated_at"))
def _upsert_incoming(t):
    return _upserted(t, ["origin"], None)


@check("upsert_unset", MERGED.format(stamp="t.updated_at"))
def _upsert_unset(t):
    return _upserted(t, ["origin", "updated_at"], None)


@check("insert_ignore", f"""
WITH target AS ({TARGET}), batch AS ({BATCH})
SELECT id, owner, status, round(price, 2) AS price, origin, updated_at FROM target
UNION ALL
SELECT id, owner, status, round(price, 2), origin, updated_at FROM batch WHERE k = 1 AND id NOT IN (SELECT id FROM target)
""")
def _insert(t):
    target = t.sql(TARGET)
    batch = _batch(t).filter("k = 1").select(*target.columns)
    out = target.unionByName(insert_absent(target, batch, ["id"]))
    return out.withColumn("price", cents("price"))
