"""A feed for tests and benchmarks: three engines' transcriptions of the orders table, disturbed by fixed rules.

FEED is SQL that Spark and other engines read alike; alpha is complete and exact, beta and gamma drop rows, add spaces,
change case, blank cells and misread some, partly both in the same way.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.prices import PriceConfig
from ..functions.typed import scalar
from ..operators.align import align_by_key
from ..operators.consensus import cells as consensus_cells
from ..operators.normalize import Normalization, Rule, normalized_rows
from ..sources.work import materialize

FIELDS = ("item_name", "catalog_code", "recorded_date", "quantity", "amount_text", "note")
ENGINES = ("alpha", "beta", "gamma")
ROLES = {"date": "recorded_date", "quantity": "quantity", "amount": "amount_text"}

BASE = """
SELECT o_orderkey AS k, c_name AS nm, concat('ORD-', CAST(o_orderkey AS VARCHAR(20))) AS code,
       substr(CAST(o_orderdate AS VARCHAR(30)), 1, 7) AS ym, substr(CAST(o_orderdate AS VARCHAR(30)), 1, 4) AS yr,
       CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR(30)) AS amt, o_orderpriority AS pr,
       CAST((o_orderkey * 7) % 50 AS VARCHAR(20)) AS q
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""
_DATE = """CASE WHEN k % 10 = 0 THEN ym WHEN k % 10 = 1 THEN yr WHEN k % 10 = 2 THEN concat(substr(ym, 3, 2), '.', substr(ym, 6, 2))
 WHEN k % 10 = 3 THEN concat(ym, ' (first) ', CAST(CAST(yr AS INT) + 1 AS VARCHAR(10))) WHEN k % 10 = 4 THEN concat(yr, '-13')
 WHEN k % 10 = 5 THEN '' WHEN k % 10 = 6 THEN 'undated' WHEN k % 10 = 7 THEN concat(yr, ' to ', CAST(CAST(yr AS INT) + 2 AS VARCHAR(10))) ELSE ym END"""
_AMOUNT = """CASE WHEN k % 8 = 0 THEN concat('USD ', amt) WHEN k % 8 = 1 THEN concat('USD ', amt, ' per item')
 WHEN k % 8 = 2 THEN concat('EUR ', amt, ' (reported equivalent USD 1,', q, '00.5)') WHEN k % 8 = 3 THEN concat('USD ', amt, ' (6 records total)')
 WHEN k % 8 = 4 THEN concat('CRD ', amt, ' thousand') WHEN k % 8 = 5 THEN concat('about ', amt) WHEN k % 8 = 6 THEN '' ELSE concat('USD ', amt, '/item') END"""
FEED = f"""
SELECT 'alpha' AS engine_id, k, nm AS item_name, code AS catalog_code, {_DATE} AS recorded_date, 'int' AS quantity_t, q AS quantity,
       {_AMOUNT} AS amount_text, pr AS note FROM base
UNION ALL
SELECT 'beta', k, CASE WHEN k % 17 = 2 THEN concat(nm, 'x') WHEN k % 19 = 4 THEN '' WHEN k % 5 = 1 THEN concat('  ', nm, '  ') ELSE nm END,
       CASE WHEN k % 3 = 0 THEN lower(code) ELSE code END, CASE WHEN k % 23 = 6 THEN 'bad' ELSE {_DATE} END,
       CASE WHEN k % 29 = 7 THEN 'str' ELSE 'int' END, q, {_AMOUNT}, CASE WHEN k % 31 = 8 THEN 'x' ELSE pr END FROM base WHERE k % 11 <> 3
UNION ALL
SELECT 'gamma', k, CASE WHEN k % 17 = 2 THEN concat(nm, 'x') WHEN k % 37 = 9 THEN concat(nm, 'y') ELSE nm END,
       concat(' ', code), {_DATE}, 'int', q, {_AMOUNT}, CASE WHEN k % 41 = 5 THEN '' ELSE pr END FROM base WHERE k % 13 <> 5
"""
_PLAIN = Rule(transforms=("strip", "collapse_whitespace"))
NORMALIZATION = Normalization(default=_PLAIN, fields={"catalog_code": Rule(transforms=("strip", "collapse_whitespace", "uppercase_latin"))})
PRICES = PriceConfig(
    currency_aliases={"USD": ["USD"], "EUR": ["EUR"], "CRD": ["CRD"], "TOK": ["TOK"]}, scale_factors={"thousand": 1000, "million": 1000000},
    per_unit_markers=("/item", "per item"), conversion_markers=("reported equivalent", "equivalent"), group_label="items", unit_label="items", unicode_text=False,
)
CENTURY = 1900


def planned(make):
    """Keeps the plan that a function makes for a session and a folder, no data: making it anew takes seconds each time."""
    kept: dict[tuple, DataFrame] = {}

    @functools.wraps(make)
    def get(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, id(spark), sf_dir)
        if key not in kept:
            kept.clear()
            kept[key] = make(spark, sf_dir)
        return kept[key]

    return get


@planned
def engine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as rows of the engines, in the shape that readers give."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name")
    base = spark.sql(BASE, orders=orders, customer=customer)
    feed = spark.sql(FEED.replace("FROM base", "FROM {base}"), base=base)
    entries = []
    for f in FIELDS:
        kind = F.col("quantity_t") if f == "quantity" else F.lit("str")
        entries += [F.lit(f), F.struct(kind.alias("t"), F.col(f).cast("string").alias("s"))]
    number = F.col("k").cast("string")
    return feed.select(
        F.concat_ws(":", "engine_id", number).alias("row_uid"), "engine_id", F.lit("1.0").alias("engine_version"), F.lit("orders").alias("document_id"),
        F.concat(F.lit("page-"), F.floor(F.col("k") / 50).cast("string")).alias("page_id"), F.lit("main").alias("table_id"), scalar("int", number).alias("row_index"),
        scalar("int", F.floor(F.col("k") / 50).cast("string")).alias("page_index"), F.lit(None).cast("string").alias("printed_page_label"), F.col("k").cast("long").alias("pos"),
        F.create_map(*entries).alias("cells"),
    )


@planned
def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_by_key(normalized_rows(engine_rows(spark, sf_dir), FIELDS, NORMALIZATION), "alpha")


def cells_of(found: DataFrame) -> DataFrame:
    return consensus_cells(found, FIELDS, ENGINES, keep_extra=False)


@planned
def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells_of(records(spark, sf_dir))


def written(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Records that are made once, written and read back, and cells of them: for plans that read them several times over."""
    found = materialize(records(spark, sf_dir), "records")
    return found, cells_of(found)


# The same in SQL, for comparison: views obs (long, normalised), voted (a row for each cell).
_NORM = "regexp_replace(trim({c}), ' +', ' ', 'g')"
ORACLE = f"""
WITH base AS ({BASE.format(orders="orders", customer="customer")}),
feed AS ({FEED}),
obs AS (
  SELECT engine_id, k, 'item_name' AS field, 'str' AS t, item_name AS raw, {_NORM.format(c="item_name")} AS s FROM feed
  UNION ALL SELECT engine_id, k, 'catalog_code', 'str', catalog_code, upper({_NORM.format(c="catalog_code")}) FROM feed
  UNION ALL SELECT engine_id, k, 'recorded_date', 'str', recorded_date, {_NORM.format(c="recorded_date")} FROM feed
  UNION ALL SELECT engine_id, k, 'quantity', quantity_t, quantity, quantity FROM feed
  UNION ALL SELECT engine_id, k, 'amount_text', 'str', amount_text, {_NORM.format(c="amount_text")} FROM feed
  UNION ALL SELECT engine_id, k, 'note', 'str', note, {_NORM.format(c="note")} FROM feed),
val AS (SELECT engine_id, k, field, raw, t, CASE WHEN t = 'str' AND s = '' THEN NULL ELSE s END AS s FROM obs),
agg AS (SELECT k, field, count(*) AS n_all, count(s) AS n FROM val GROUP BY k, field),
kinds AS (SELECT k, field, t, s, count(*) AS votes FROM val WHERE s IS NOT NULL GROUP BY k, field, t, s),
best AS (SELECT k, field, count(*) AS n_kinds, max(votes) AS top, arg_max(t, votes) AS t, arg_max(s, votes) AS s FROM kinds GROUP BY k, field),
voted AS (
  SELECT a.k, a.field, a.n_all, a.n, coalesce(b.n_kinds, 0) AS n_kinds,
    CASE WHEN a.n = 0 THEN CASE WHEN a.n_all >= 2 THEN 'unanimous' ELSE 'missing' END
         WHEN b.n_kinds = 1 THEN CASE WHEN a.n = 1 THEN 'missing' ELSE 'unanimous' END
         WHEN b.top >= greatest(2, CAST(floor(a.n * 0.5) AS INT) + 1) THEN 'majority' ELSE 'conflict' END AS status, b.t, b.s
  FROM agg a LEFT JOIN best b ON a.k = b.k AND a.field = b.field),
ids AS (
  SELECT k, concat('rec_', substr(sha256(concat('["orders","page-', CAST(k // 50 AS VARCHAR), '","main","alpha",', CAST(k AS VARCHAR), ',', CAST(k // 50 AS VARCHAR), ']')), 1, 24)) AS record_id
  FROM base),
cell AS (
  SELECT v.k, i.record_id, concat('cell_', substr(sha256(concat('["', i.record_id, '","', v.field, '"]')), 1, 24)) AS cell_id, v.field, v.status, v.n_all, v.n,
    CASE WHEN v.n > 0 AND v.status <> 'conflict' THEN v.t END AS chosen_t, CASE WHEN v.n > 0 AND v.status <> 'conflict' THEN v.s END AS chosen
  FROM voted v JOIN ids i ON v.k = i.k)
"""
