"""The upsert of every current table by its specification, and the table that rewrites only what a batch touches."""

from pyspark.sql import functions as F

from strandmart.checks.registry import cents, check
from strandmart.checks.relational import MERGED, TARGET, _batch
from strandmart.checks.source_checks import LOADED, loaded, scratch
from strandmart.plans.upserts import SPECS, apply_upsert
from strandmart.session import fit_tasks
from strandmart.sources.indexed import IndexedTable

# Golden values, written from the loaders' statements, not from the engine's table: key | columns that a match leaves as they are |
# what a match does to updated_at (none: the table has no such column).
GOLDEN = {
    "upserts_reports": """
        U01 order_id drug_name gene_symbol | | none
        U02 id | | incoming
        U03 id | | incoming
        U39 file_name | created_at | run
    """,
    "upserts_illumina": """
        U04 id | time_created | run
        U05 id | time_created created_at | run
        U06 session_id id_library id_repository | created_at | run
        U07 session_id | created_at | run
        U08 id_repository lane id_library reads | created_at | run
        U09 id_repository run_name | created_at | run
        U10 id_repository lane read_number yield | created_at | run
    """,
    "upserts_mgi": """
        U11 id_repository run_name | created_at | run
        U12 id_repository run_name | created_at | run
        U43 id_repository id_flowcell id_pool id_dnb id_index | created_at | run
        U44 id_repository run_name | created_at | incoming
        U45 id_repository run_name | created_at | incoming
        U46 original_sample_id | created_at | incoming
        U47 id_repository run_name | created_at | incoming
    """,
    "upserts_registry": """
        U13 id | created_by created_at | incoming
        U14 id | created_at | incoming
        U15 id_subject | created_by creation_date | none
        U16 id | | incoming
        U17 participant_id institution_id document_type | created_by | none
        U18 id | created_at | incoming
        U19 id | | incoming
        U20 id | | incoming
    """,
    "upserts_registry_forms": """
        U21 id | | incoming
        U22 id | created_at | incoming
        U23 id | created_at | incoming
        U24 id_subject | created_by hospital_name created_at creation_date | run
        U25 id | created_at | incoming
        U26 id | | incoming
        U27 id | created_by created_at | incoming
        U28 id_subject | created_at creation_date | run
        U29 id_subject | created_at | incoming
    """,
    "upserts_biobank": """
        U30 id | created_at | run
        U31 id_patient | created_at | run
        U32 id | created_at | incoming
        U33 id_project | | incoming
        U34 id | created_at | run
        U35 id | created_at | incoming
        U36 id | created_at | incoming
        U37 id | created_at | run
        U38 transfer_id | created_at | run
    """,
    "upserts_ont": """
        U40 id_repository run_name | created_at | run
        U41 id_repository run_name | created_at | run
        U42 id_repository | created_at | run
    """,
}
#: Columns of which any may be kept by a match.
ONCE = ("created_at", "created_by", "creation_date", "time_created", "hospital_name")


def _golden(text):
    for line in text.strip().splitlines():
        name, rest = line.strip().split(" ", 1)
        keys, keep, stamp = (part.split() for part in rest.split("|"))
        yield name, keys, keep, stamp[0]


def _key_columns(keys):
    """Digits of a number, so that every column is needed to tell keys apart."""
    n = len(keys)
    first = f"CAST(CAST(floor(o_orderkey / {10 ** (n - 1)}) AS BIGINT) AS STRING) AS `{keys[0]}`"
    return [first, *(f"CAST(CAST(floor(o_orderkey / {10 ** (n - 1 - i)}) AS BIGINT) % 10 AS STRING) AS `{k}`" for i, k in enumerate(keys[1:], 1))]


def _side(keys, stamp, where, word, k="0"):
    columns = [*_key_columns(keys), f"concat('{word}', CAST({k} AS STRING)) AS payload", *(f"'{word}' AS {c}" for c in ONCE), f"{k} AS k"]
    columns += [] if stamp == "none" else [f"'{word}' AS updated_at"]
    return f"SELECT {', '.join(columns)} FROM orders" + (" CROSS JOIN (SELECT 1 AS k UNION ALL SELECT 2 AS k)" if k == "k" else "") + f" WHERE {where}"


def _sides(keys, stamp):
    return _side(keys, stamp, "o_orderkey % 3 <> 0", "old"), _side(keys, stamp, "o_orderkey % 2 = 0", "new", "k")


def _oracle(text):
    parts = []
    for name, keys, keep, stamp in _golden(text):
        old, new = (side.replace("`", '"') for side in _sides(keys, stamp))
        same = " AND ".join(f't."{k}" = s."{k}"' for k in keys)
        key = " || '|' || ".join(f'coalesce(t."{k}", s."{k}")' for k in keys)
        once = ", ".join(f"coalesce({f't.{c}, s.{c}' if c in keep else f's.{c}, t.{c}'}) AS {c}" for c in ONCE)
        matched = {"run": "'run'", "incoming": "s.updated_at"}.get(stamp)
        updated = f"CASE WHEN s.payload IS NULL THEN t.updated_at WHEN t.payload IS NULL THEN s.updated_at ELSE {matched} END" if matched else "NULL"
        parts.append(
            f"SELECT '{name}' AS spec, {key} AS key, coalesce(s.payload, t.payload) AS payload, {once}, CAST({updated} AS VARCHAR) AS updated_at "
            f"FROM ({old}) t FULL JOIN (SELECT * FROM ({new}) WHERE k = 2) s ON {same}"
        )
    return "\nUNION ALL ".join(parts)


def _family(text):
    def build(t):
        """Two halves of the orders, the second sent twice, merged by each specification of the family."""
        fit_tasks(t.spark, t.size("orders"))
        made = None
        for name, keys, _, stamp in _golden(text):
            old, new = (t.sql(side) for side in _sides(keys, stamp))
            out = apply_upsert(SPECS[name], old.drop("k"), new, F.lit("run"), ("k",))
            updated = F.col("updated_at") if stamp != "none" else F.lit(None).cast("string")
            key = F.concat_ws("|", *[F.col(f"`{k}`") for k in keys])
            out = out.select(F.lit(name).alias("spec"), key.alias("key"), "payload", *ONCE, updated.alias("updated_at"))
            made = out if made is None else made.unionAll(out)
        return made

    return build


for _name, _text in GOLDEN.items():
    check(_name, _oracle(_text))(_family(_text))


# --- copy on write --------------------------------------------------------


def _stored(t, buckets=16, most_shares=2):
    table = IndexedTable(t.spark, scratch(t), ["id"], buckets, most_shares)
    table.write(t.sql(TARGET), "v1")
    return table


def _one(t, key):
    return t.spark.range(1).select(key.cast("bigint").alias("id"), F.lit(-1.0).alias("price"), F.lit("one").alias("status"), F.lit(1).alias("k"))


@check("upsert_indexed", f"""
WITH merged AS ({MERGED.format(stamp="3")})
SELECT id, owner, CASE WHEN id = (SELECT min(id) FROM merged) THEN 'one' ELSE status END AS status,
       CASE WHEN id = (SELECT min(id) FROM merged) THEN -1.0 ELSE price END AS price, origin,
       CASE WHEN id = (SELECT min(id) FROM merged) THEN 4 ELSE updated_at END AS updated_at
FROM merged UNION ALL SELECT NULL, NULL, 'one', -1.0, NULL, NULL
""")
def _indexed(t):
    """A large batch, a batch of one key without some columns, and one of the null key."""
    table = _stored(t)
    table.upsert(_batch(t), "v2", ["id"], ["origin"], ["k"], ("updated_at", F.lit(3)))
    lowest = table.read().agg(F.min("id")).first()[0]
    table.upsert(_one(t, F.lit(lowest)), "v3", ["id"], ["origin"], ["k"], ("updated_at", F.lit(4)))
    table.upsert(_one(t, F.lit(None)), "v4", ["id"], ["origin"], ["k"])
    return table.read().withColumn("price", cents("price"))


@check("upsert_shares", f"""
WITH target AS (SELECT count(*) AS n FROM ({TARGET}))
SELECT step, folder, shares, n + new AS table_rows FROM target, (VALUES
  ('1 old key', 'v1', 15, 0), ('1 old key', 'v2', 1, 0),
  ('2 new key', 'v1', 15, 1), ('2 new key', 'v2', 1, 1), ('2 new key', 'v3', 1, 1),
  ('3 new key again', 'v1', 15, 1), ('3 new key again', 'v2', 1, 1), ('3 new key again', 'v4', 1, 1),
  ('4 full bucket', 'v1', 14, 2), ('4 full bucket', 'v2', 1, 2), ('4 full bucket', 'v5', 1, 2)) AS x (step, folder, shares, new)
""")
def _shares(t):
    """Which versions' files make up the table: a batch of one key writes one share and leaves all others as they are.

    The bucket of the second new key holds two shares already, the most it may, so they become one.
    """
    table = _stored(t)
    lowest = table.read().agg(F.min("id")).first()[0]
    second = t.spark.range(1, 1000).select((-F.col("id")).alias("id"))
    place = F.pmod(F.xxhash64("id"), F.lit(16))
    # another new key of the bucket where -1 lies
    fellow = second.where((place == second.where("id = -1").select(place).first()[0]) & (F.col("id") < -1)).agg(F.max("id")).first()[0]
    steps = [("1 old key", lowest), ("2 new key", -1), ("3 new key again", -1), ("4 full bucket", fellow)]
    made = None
    for k, (step, key) in enumerate(steps, 2):
        table.upsert(_one(t, F.lit(key)), f"v{k}", ["id"], ["origin"], ["k"])
        shares = table.shares().groupBy("folder").agg(F.count("*").alias("shares"))
        shares = shares.select(F.lit(step).alias("step"), "folder", "shares", F.lit(table.read().count()).alias("table_rows"))
        made = shares if made is None else made.unionAll(shares)
    return made


@check("load_indexed", LOADED)
def _load_indexed(t):
    """The two days of ``load_job`` into a table that rewrites only what a day touches."""
    return loaded(t, IndexedTable(t.spark, scratch(t), list(SPECS["U06"].keys), 8))
