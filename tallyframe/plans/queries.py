"""Queries over the driver's tables, one for each operator, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scan as secrets
from ..functions import text
from ..functions.dates import parse_date
from ..functions.prices import numeric, parse_quantity, segments
from ..functions.typed import quoted, scalar_json
from ..operators import admission, align, decisions, enrich, quality, review
from ..operators.consensus import missing_engines
from ..operators.normalize import Rule, collisions, exploded, normalized_rows, observations
from ..sources import artifacts, jsonl, sinks, transcription
from ..sources.profile import parse_profile
from ..sources.work import materialize, new_path
from . import feeds
from .feeds import CENTURY, ENGINES, FIELDS, NORMALIZATION, PRICES, ROLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, feed: bool = True):
    """Registers a query under the function's name; feed: whether the SQL reads the views of the feed."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = (feeds.ORACLE if feed else "") + sql
        return f

    return add


def _k(index="row_index"):
    return F.col(f"{index}.s").cast("long")


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- voting


@query("SELECT field, status, count(*) AS n FROM cell GROUP BY field, status")
def consensus_status_counts(spark, sf_dir):
    return feeds.cells(spark, sf_dir).groupBy("field", "status").agg(F.count("*").alias("n"))


@query("SELECT record_id, cell_id, field, status, chosen_t, chosen FROM cell")
def consensus_cells(spark, sf_dir):
    return feeds.cells(spark, sf_dir).select("record_id", "cell_id", "field", "status", F.col("chosen.t").alias("chosen_t"), F.col("chosen.s").alias("chosen"))


@query("""SELECT i.record_id, concat_ws(',', CASE WHEN i.k % 11 = 3 THEN 'beta' END, CASE WHEN i.k % 13 = 5 THEN 'gamma' END) AS missing FROM ids i""")
def missing_engines_by_record(spark, sf_dir):
    return missing_engines(feeds.records(spark, sf_dir), ENGINES).select("record_id", F.array_join("missing_engine_ids", ",").alias("missing"))


@query("""SELECT c.record_id, c.field, string_agg(v.engine_id, ',' ORDER BY v.engine_id) AS supporters FROM cell c JOIN val v ON c.k = v.k AND c.field = v.field
AND ((c.n = 0 AND c.status = 'unanimous') OR (c.chosen IS NOT NULL AND v.t = c.chosen_t AND v.s = c.chosen)) GROUP BY c.record_id, c.field""")
def supporters(spark, sf_dir):
    cells = feeds.cells(spark, sf_dir)
    own = F.transform(F.filter("candidates", lambda c: F.array_contains(F.col("supporting_candidate_ids"), c["candidate_id"])), lambda c: c["engine_id"])
    return text.settled(cells.select("record_id", "field", F.array_join(own, ",").alias("named")), supporters=F.col("named")).drop("named").where("supporters <> ''")


@query("""SELECT v.k, v.field, count(DISTINCT CASE WHEN v.s IS NOT NULL THEN concat(v.t, ':', v.s) END) AS n_kinds, count(v.s) AS n_votes FROM val v GROUP BY v.k, v.field""")
def typed_vote(spark, sf_dir):
    rows = normalized_rows(feeds.engine_rows(spark, sf_dir), FIELDS, NORMALIZATION)
    long = exploded(rows, _k().alias("k"))
    return long.groupBy("k", "field").agg(F.count_distinct(F.when(F.col("c.value").isNotNull(), F.concat_ws(":", "c.value.t", "c.value.s"))).alias("n_kinds"), F.count("c.value").alias("n_votes"))


# -- normalisation and scalars


@query("SELECT engine_id, k, field, raw, s AS value FROM val")
def normalize_text(spark, sf_dir):
    rows = normalized_rows(feeds.engine_rows(spark, sf_dir), FIELDS, NORMALIZATION)
    long = exploded(rows, "engine_id", _k().alias("k"))
    return long.select("engine_id", "k", "field", F.col("c.raw.s").alias("raw"), F.col("c.value.s").alias("value"))


_BLANK = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@query(f"SELECT conv_id, turn, trim(regexp_replace(text, '{_BLANK}', ' ', 'g')) AS collapsed, regexp_replace(text, '{_BLANK}', '', 'g') AS removed FROM conversations", feed=False)
def normalize_whitespace(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return rows.select("conv_id", "turn", text.collapse_whitespace(F.col("text")).alias("collapsed"), text.remove_whitespace(F.col("text")).alias("removed"))


@query("""SELECT o_orderkey, replace(concat(o_orderpriority, '|', o_orderstatus), '–', '-') AS a, translate(replace(o_orderpriority, '-', '—'), '‐‑‒–—−', '------') AS b FROM orders""", feed=False)
def normalize_dashes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    changed = F.replace(F.col("o_orderpriority"), F.lit("-"), F.lit("—"))
    return orders.select("o_orderkey", text.normalize_dashes(F.concat_ws("|", "o_orderpriority", "o_orderstatus")).alias("a"), text.normalize_dashes(changed).alias("b"))


_NUMBERS = "concat(CASE WHEN l_orderkey % 3 = 0 THEN '+' WHEN l_orderkey % 3 = 1 THEN '-' ELSE '00' END, CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS {s}), CASE WHEN l_orderkey % 5 = 0 THEN '0' WHEN l_orderkey % 5 = 1 THEN 'x' ELSE '' END)"


@query(f"""WITH n AS (SELECT l_orderkey, l_linenumber, {_NUMBERS.format(s='VARCHAR')} AS raw FROM lineitem)
SELECT l_orderkey, l_linenumber, raw, CASE WHEN regexp_full_match(raw, '[+-]?[0-9]+\\.[0-9]*') THEN
  concat(CASE WHEN raw LIKE '-%' THEN '-' ELSE '' END, regexp_replace(CAST(CAST(abs(CAST(raw AS DECIMAL(20, 4))) AS DECIMAL(20, 4)) AS VARCHAR), '\\.?0+$', '')) ELSE raw END AS canonical FROM n""", feed=False)
def canonical_number(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.expr(_NUMBERS.format(s="STRING")).alias("raw"))
    return rows.select("*", text.canonical_number(F.col("raw")).alias("canonical"))


@query("SELECT engine_id, k, CASE WHEN field = 'note' THEN 'remark' ELSE field END AS field, s AS value FROM val WHERE field IN ('note', 'item_name')")
def field_alias(spark, sf_dir):
    from ..operators.normalize import Normalization

    config = Normalization(default=NORMALIZATION.default, aliases={"note": "remark"})
    rows = normalized_rows(feeds.engine_rows(spark, sf_dir), ("note", "item_name"), config)
    return exploded(rows, "engine_id", _k().alias("k")).select("engine_id", "k", "field", F.col("c.value.s").alias("value"))


@query("SELECT engine_id || ':' || CAST(k AS VARCHAR) AS row_uid, 'label' AS field, 2 AS n FROM feed")
def alias_collisions(spark, sf_dir):
    from ..operators.normalize import Normalization

    return collisions(feeds.engine_rows(spark, sf_dir), FIELDS, Normalization(aliases={"note": "label", "item_name": "label"}))


@query("SELECT field, count(*) AS n_missing FROM val WHERE s IS NULL GROUP BY field")
def missing_sentinel(spark, sf_dir):
    rows = normalized_rows(feeds.engine_rows(spark, sf_dir), FIELDS, NORMALIZATION)
    return observations(rows).where("value IS NULL").groupBy("field").agg(F.count("*").alias("n_missing"))


@query()
def nfkc_normalize(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.sha2(text.nfkc(F.col("text")), 256).alias("nfkc_sha256"), F.sha2(text.casefold(F.col("text")), 256).alias("folded_sha256"))


@query("SELECT k, record_id FROM ids")
def stable_record_id(spark, sf_dir):
    return feeds.records(spark, sf_dir).select(F.get("members", F.lit(0))["row_index"]["s"].cast("long").alias("k"), "record_id")


@query("SELECT record_id, field, cell_id FROM cell WHERE field IN ('item_name', 'quantity')")
def stable_cell_id(spark, sf_dir):
    return feeds.cells(spark, sf_dir).where(F.col("field").isin("item_name", "quantity")).select("record_id", "field", "cell_id")


@query("SELECT c_custkey, CAST(to_json(concat(c_name, chr(10), '\"', c_mktsegment, '\\')) AS VARCHAR) AS quoted FROM customer", feed=False)
def canonical_json_text(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", quoted(F.concat(F.col("c_name"), F.lit('\n"'), F.col("c_mktsegment"), F.lit("\\"))).alias("quoted"))


@query("SELECT page_id, row_number() OVER (ORDER BY p) AS n FROM (SELECT DISTINCT CONCAT('page-', CAST(k // 50 AS VARCHAR)) AS page_id, k // 50 AS p FROM feed)")
def natural_section_order(spark, sf_dir):
    pages = feeds.engine_rows(spark, sf_dir).select("page_id").distinct()
    ordered = pages.orderBy(text.natural_key(F.col("page_id")), "page_id").select("page_id")
    return spark.createDataFrame(ordered.rdd.zipWithIndex().map(lambda r: (r[0].page_id, r[1] + 1)), "page_id string, n long")


# -- admission


@query("""SELECT concat(engine_id, ':', CAST(k AS VARCHAR)) AS row_uid, 'undeclared_field' AS violation FROM feed
UNION ALL SELECT concat(engine_id, ':', CAST(k AS VARCHAR)), 'engine_version_required' FROM feed WHERE k % 7 = 0
UNION ALL SELECT concat(engine_id, ':', CAST(k AS VARCHAR)), 'page_index_invalid' FROM feed WHERE k % 9 = 0
UNION ALL SELECT concat(engine_id, ':', CAST(k AS VARCHAR)), 'page_index_required' FROM feed WHERE k % 9 = 1""")
def admission_violations(spark, sf_dir):
    k = _k()
    rows = feeds.engine_rows(spark, sf_dir).withColumns(
        {
            "engine_version": F.when(k % 7 == 0, "").otherwise(F.col("engine_version")),
            "page_index": F.when(k % 9 == 0, F.struct(F.lit("int").alias("t"), F.lit("-1").alias("s"))).when(k % 9 != 1, F.col("page_index")),
        }
    )
    return admission.row_violations(rows, [f for f in FIELDS if f != "note"], page_index_required=True)


@query("""SELECT concat(engine_id, ':', CAST(k AS VARCHAR), '-again') AS row_uid, 2 AS occurrence FROM feed WHERE k % 20 = 0""")
def duplicate_identity(spark, sf_dir):
    rows = feeds.engine_rows(spark, sf_dir)
    again = rows.where(_k() % 20 == 0).withColumns({"row_uid": F.concat("row_uid", F.lit("-again")), "pos": F.col("pos") + 1})
    return admission.duplicate_identities(rows.unionByName(again))


@query("SELECT count(DISTINCT engine_id) AS engines, count(DISTINCT engine_id) >= 3 AS enough FROM feed")
def engine_minimum(spark, sf_dir):
    return admission.engine_count(feeds.engine_rows(spark, sf_dir), 3)


# -- alignment


@query("""SELECT i.record_id, concat('page-', CAST(i.k // 50 AS VARCHAR)) AS page_id, CAST(row_number() OVER (PARTITION BY i.k // 50 ORDER BY i.k) AS INT) AS ordinal,
concat_ws(',', 'alpha', CASE WHEN i.k % 11 <> 3 THEN 'beta' END, CASE WHEN i.k % 13 <> 5 THEN 'gamma' END) AS engines FROM ids i""")
def align_exact_key(spark, sf_dir):
    records = feeds.records(spark, sf_dir)
    return records.select("record_id", "page_id", "ordinal", F.array_join("members.engine_id", ",").alias("engines"))


@query("""SELECT a.k, round((CASE WHEN a.nm IS NOT NULL AND b.nm IS NOT NULL AND a.nm = b.nm THEN 0.5 ELSE 0 END + CASE WHEN a.code = b.code THEN 0.3 ELSE 0 END
+ CASE WHEN a.note IS NOT NULL AND b.note IS NOT NULL AND a.note = b.note THEN 0.2 ELSE 0 END)
/ (CASE WHEN a.nm IS NOT NULL AND b.nm IS NOT NULL THEN 0.5 ELSE 0 END + 0.3 + CASE WHEN a.note IS NOT NULL AND b.note IS NOT NULL THEN 0.2 ELSE 0 END), 9) AS similarity
FROM (SELECT k, max(s) FILTER (field = 'item_name') AS nm, max(s) FILTER (field = 'catalog_code') AS code, max(s) FILTER (field = 'note') AS note FROM val WHERE engine_id = 'alpha' GROUP BY k) a
JOIN (SELECT k, max(s) FILTER (field = 'item_name') AS nm, max(s) FILTER (field = 'catalog_code') AS code, max(s) FILTER (field = 'note') AS note FROM val WHERE engine_id = 'beta' GROUP BY k) b ON a.k = b.k""")
def align_similarity_exact(spark, sf_dir):
    config = align.AlignmentConfig(weights={"item_name": 0.5, "catalog_code": 0.3, "note": 0.2}, fuzzy_strings=False)
    rows = normalized_rows(feeds.engine_rows(spark, sf_dir), ("item_name", "catalog_code", "note"), NORMALIZATION)
    a = rows.where("engine_id = 'alpha'").select(_k().alias("k"), F.col("norm").alias("a"))
    b = rows.where("engine_id = 'beta'").select(_k().alias("k"), F.col("norm").alias("b"))
    return a.join(b, "k").select("k", F.round(align.exact_similarity(None, "a", "b", config.weights, config), 9).alias("similarity"))


@query("""SELECT concat('page-', CAST(k // 50 AS VARCHAR)) AS page_id, engine_id || ':' || CAST(k AS VARCHAR) AS row_uid,
CAST(dense_rank() OVER (PARTITION BY k // 50 ORDER BY k) AS INT) AS ordinal FROM feed""")
def align_dynamic_key(spark, sf_dir):
    """The dynamic programme with the key alone: keys only ever drop out, so it must find the join by key."""
    config = align.AlignmentConfig(weights={"catalog_code": 1.0}, fuzzy_strings=False, anchor_engine="alpha")
    rows = normalized_rows(feeds.engine_rows(spark, sf_dir), ("catalog_code",), NORMALIZATION)
    return align.align_fuzzy(rows, config).select("page_id", "row_uid", "ordinal")


@query()
def align_fuzzy(spark, sf_dir):
    config = align.AlignmentConfig(weights={"item_name": 0.3, "catalog_code": 0.25, "recorded_date": 0.1, "quantity": 0.1}, anchor_engine="alpha")
    rows = normalized_rows(feeds.engine_rows(spark, sf_dir), FIELDS, NORMALIZATION)
    return align.align_fuzzy(rows, config)


# -- review and decisions


@query("SELECT cell_id, record_id, field, status FROM cell WHERE status IN ('conflict', 'missing')")
def review_queue(spark, sf_dir):
    return review.review_items(feeds.cells(spark, sf_dir)).select("cell_id", "record_id", "field", "status")


@query("""SELECT c.cell_id, c.status, string_agg(concat(v.engine_id, '=', CASE WHEN v.s IS NULL THEN 'null' WHEN v.t = 'str' THEN concat('"', v.s, '"') ELSE v.s END), ' | ' ORDER BY v.engine_id) AS options
FROM cell c JOIN val v ON c.k = v.k AND c.field = v.field WHERE c.status = 'conflict' GROUP BY c.cell_id, c.status""")
def decision_template(spark, sf_dir):
    items = review.review_items(feeds.cells(spark, sf_dir), ("conflict",))
    return review.decision_template(items).select("cell_id", "status", "options")


def _decisions(cells):
    """For each conflict on item_name: alpha's value, by its candidate where the row number is even."""
    first = F.get("candidates", F.lit(0))
    even = first["engine_id"].isNotNull() & (F.col("ordinal") % 2 == 0)
    nothing = F.lit(None).cast("string")
    return cells.where("status = 'conflict' AND field = 'item_name'").select(
        "cell_id", first["value"].alias("chosen"), F.when(even, first["candidate_id"]).alias("candidate_id"), F.lit("seen").alias("reason"), F.lit("r").alias("reviewer"),
        F.lit("2024-01-01").alias("decided_at"), nothing.alias("decision_id"), nothing.alias("source_decision_id"), F.lit("{}").alias("metadata_json"),
    )


@query("""SELECT c.cell_id, c.field, c.status, CASE WHEN c.status = 'conflict' AND c.field = 'item_name' THEN a.s ELSE c.chosen END AS chosen,
c.status = 'conflict' AND c.field = 'item_name' AS decided FROM cell c LEFT JOIN val a ON a.k = c.k AND a.field = c.field AND a.engine_id = 'alpha'""")
def apply_decisions(spark, sf_dir):
    _, cells = feeds.written(spark, sf_dir)
    out = review.apply_decisions(cells, _decisions(cells), check=False)
    return out.select("cell_id", "field", "status", F.col("chosen.s").alias("chosen"), F.col("decision").isNotNull().alias("decided"))


@query("SELECT concat(cell_id, '-none') AS cell_id FROM cell WHERE status = 'conflict' AND field = 'item_name'")
def unknown_decisions(spark, sf_dir):
    _, cells = feeds.written(spark, sf_dir)
    own = _decisions(cells)
    return review.unknown_decisions(own.unionByName(own.withColumn("cell_id", F.concat("cell_id", F.lit("-none")))), cells).select("cell_id")


@query("SELECT 'unknown_cell' AS violation, count(*) AS n FROM cell WHERE status = 'conflict' AND field = 'item_name' UNION ALL SELECT 'duplicate', count(*) FROM cell WHERE status = 'conflict' AND field = 'item_name'")
def decision_violations(spark, sf_dir):
    _, cells = feeds.written(spark, sf_dir)
    own = _decisions(cells)
    lost = own.withColumn("cell_id", F.concat("cell_id", F.lit("-none")))
    return review.decision_violations(own.unionByName(own).unionByName(lost), cells).groupBy("violation").agg(F.count("*").alias("n"))


def _events(spark, records, kind, fields):
    """Events on all records and the fields, from their own evidence."""
    alpha = F.get(F.filter("members", lambda m: m["engine_id"] == "alpha"), F.lit(0))
    rows = records.withColumn("_a", alpha).withColumn("_k", F.col("_a.row_index.s").cast("long"))
    nothing = F.lit(None).cast("string")
    one = rows.withColumn("field", F.explode(F.array(*map(F.lit, fields))))
    field = F.col("field")
    return one.select(
        F.concat_ws("-", F.lit("ev"), F.col("_k").cast("string")).alias("event_id"), F.lit(kind).alias("decision_type"), F.lit("approved").alias("status_event"),
        "document_id", "page_id", "table_id", F.col("_a.row_index").alias("row_index"), "field", F.lit("alpha").alias("engine_id"), F.col("_a.norm")[field]["raw"].alias("raw"),
        F.col("_a.norm")[field]["value"].alias("value"), F.transform("members", lambda m: m["engine_id"]).alias("engine_ids"),
        F.transform("members", lambda m: scalar_json(m["norm"][field]["raw"])).alias("raw_values"),
        F.struct(F.lit("int").alias("t"), (F.col("_k") - 1).cast("string").alias("s")).alias("previous_index"), nothing.alias("reviewer"), F.lit("seen").alias("rationale"), nothing.alias("decided_at"), "_k",
    )


@query("SELECT concat('ev-', CAST(k AS VARCHAR)) AS event_id, 'item_name' AS field, CAST(1 AS BIGINT) AS n_records, record_id FROM ids UNION ALL SELECT 'lost', 'item_name', 0, NULL")
def event_locator(spark, sf_dir):
    records, _ = feeds.written(spark, sf_dir)
    events = _events(spark, records, "choose_candidate", ["item_name"])
    lost = events.limit(1).withColumns({"event_id": F.lit("lost"), "page_id": F.lit("nowhere")})
    return decisions.locate(events.unionByName(lost).drop("_k"), records)


@query("""SELECT concat('ev-', CAST(c.k AS VARCHAR)) AS source_decision_id, c.cell_id, a.s AS chosen, CASE WHEN c.status IN ('unanimous', 'majority') THEN 'already_resolved' END AS violation
FROM cell c JOIN val a ON a.k = c.k AND a.field = c.field AND a.engine_id = 'alpha' WHERE c.field = 'item_name'""")
def compile_choose(spark, sf_dir):
    records, cells = feeds.written(spark, sf_dir)
    made = decisions.compile_choose(_events(spark, records, "choose_candidate", ["item_name"]).drop("_k"), records, cells, "r", "2024-01-01")
    return made.select("source_decision_id", "cell_id", F.col("chosen.s").alias("chosen"), "violation")


@query("""SELECT concat('ev-', CAST(c.k AS VARCHAR)) AS source_decision_id, c.cell_id, c.chosen FROM cell c WHERE c.k % 11 = 3 AND c.k % 13 = 5 AND c.status IN ('missing', 'conflict')""")
def compile_accept_row(spark, sf_dir):
    records, cells = feeds.written(spark, sf_dir)
    made = decisions.compile_accept_row(_events(spark, records, "accept_single_source_row", ["note"]).drop("_k"), records, cells, list(ENGINES), "r", "2024-01-01")
    return made.where("violation IS NULL").select("source_decision_id", "cell_id", F.col("chosen.s").alias("chosen"))


@query("""SELECT concat('ev-', CAST(c.k AS VARCHAR)) AS source_decision_id, c.cell_id,
CASE WHEN p.k IS NULL THEN 'unknown_or_ambiguous_row' WHEN c.status IN ('unanimous', 'majority') THEN 'already_resolved' WHEN p.status NOT IN ('unanimous', 'majority') THEN 'predecessor_unresolved'
 WHEN (p.chosen IS DISTINCT FROM a.s) THEN 'value_mismatch' END AS violation
FROM cell c JOIN val a ON a.k = c.k AND a.field = c.field AND a.engine_id = 'alpha' LEFT JOIN cell p ON p.k = c.k - 1 AND p.field = c.field AND p.k // 50 = c.k // 50 WHERE c.field = 'note'""")
def compile_repeat_marker(spark, sf_dir):
    records, cells = feeds.written(spark, sf_dir)
    made = decisions.compile_repeat_marker(_events(spark, records, "resolve_repeat_marker", ["note"]).drop("_k"), records, cells, "r", "2024-01-01")
    return made.select("source_decision_id", "cell_id", "violation")


# -- dates, quantities, prices

_PARTS = """years AS (SELECT engine_id, k, recorded_date AS raw, regexp_extract_all(recorded_date, '(?:^|[^0-9])([0-9]{4}|[0-9]{2})(?:[.\\-/]([0-9]{1,2}))?', 1) AS y,
 regexp_extract_all(recorded_date, '(?:^|[^0-9])([0-9]{4}|[0-9]{2})(?:[.\\-/]([0-9]{1,2}))?', 2) AS m FROM feed)"""


def _years(small: str) -> str:
    return f"CASE WHEN CAST(x AS INT) >= 100 THEN CAST(x AS INT) ELSE {small} END"


_DATES = (
    """, """ + _PARTS + """, d AS (SELECT engine_id, k, raw, list_transform(y, lambda x: {years}) AS y, list_transform(m, lambda x: CASE WHEN x = '' THEN NULL ELSE CAST(x AS INT) END) AS m FROM years),
e AS (SELECT engine_id, k, raw, y, m, len(list_filter(m, lambda x: x IS NOT NULL AND (x < 1 OR x > 12))) > 0 AS bad_month, list_has_any([y_ IS NULL FOR y_ IN y], [true]) AS bad_year, len(list_filter(m, lambda x: x IS NOT NULL)) > 0 AS has_m FROM d)
SELECT engine_id, k, nullif(raw, '') AS date_raw, CASE WHEN len(y) > 0 AND NOT bad_month AND NOT bad_year THEN printf('%04d', y[1]) || coalesce(printf('-%02d', m[1]), '') END AS date_start,
 CASE WHEN len(y) > 0 AND NOT bad_month AND NOT bad_year THEN printf('%04d', y[-1]) || coalesce(printf('-%02d', m[-1]), '') END AS date_end,
 CASE WHEN raw = '' THEN 'missing' WHEN len(y) = 0 OR bad_month OR bad_year THEN 'unresolved' WHEN len(y) = 1 THEN CASE WHEN has_m THEN 'month' ELSE 'year' END WHEN has_m THEN 'range_month' ELSE 'range_year' END AS date_precision,
 CASE WHEN raw = '' THEN NULL WHEN len(y) = 0 THEN 'no configured year pattern matched' WHEN bad_year THEN 'two-digit year requires a configured century or edition year'
  WHEN bad_month THEN 'invalid month: ' || CAST(list_filter(m, lambda x: x < 1 OR x > 12)[1] AS VARCHAR) END AS unresolved_reason FROM e"""
)


def _date_query(spark, sf_dir, **config):
    parsed = parse_date(F.col("cells")["recorded_date"]["s"], unicode_text=False, **config)
    return feeds.engine_rows(spark, sf_dir).select("engine_id", _k().alias("k"), parsed.alias("d")).select("engine_id", "k", "d.*")


@query(_DATES.replace("{years}", _years(f"{CENTURY} + CAST(x AS INT)")))
def date_century(spark, sf_dir):
    return _date_query(spark, sf_dir, century=CENTURY)


@query(_DATES.replace("{years}", _years("CASE WHEN 1900 + CAST(x AS INT) > 1996 + 5 THEN 1800 + CAST(x AS INT) ELSE 1900 + CAST(x AS INT) END")))
def date_edition_year(spark, sf_dir):
    return _date_query(spark, sf_dir, edition_year=1996)


@query(_DATES.replace("{years}", _years("NULL")))
def date_parse(spark, sf_dir):
    return _date_query(spark, sf_dir)


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN CAST(printf('%d', c_custkey) AS DOUBLE) WHEN c_custkey % 3 = 1 THEN CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS DOUBLE) END AS quantity_numeric,
CASE WHEN c_custkey % 3 = 2 THEN c_name END AS quantity_text FROM customer""", feed=False)
def quantity_parse(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    number = F.col("c_custkey")
    raw = F.when(number % 3 == 0, F.concat(F.lit(" "), F.regexp_replace(number.cast("string"), "([0-9])([0-9]{3})$", "$1,$2"))).when(number % 3 == 1, F.col("c_acctbal").cast("decimal(18,2)").cast("string")).otherwise(F.col("c_name"))
    parsed = parse_quantity(raw)
    return c.select("c_custkey", parsed["numeric"].alias("quantity_numeric"), parsed["unparsed"].alias("quantity_text"))


@query("""SELECT engine_id, k, array_to_string(list_filter(list_transform(regexp_split_to_array(amount_text, '[()]'), lambda x: trim(x)), lambda x: x <> ''), '|') AS parts FROM feed""")
def price_segments(spark, sf_dir):
    rows = feeds.engine_rows(spark, sf_dir)
    return rows.select("engine_id", _k().alias("k"), F.array_join(segments(F.col("cells")["amount_text"]["s"], False), "|").alias("parts"))


_PRICES = """, raw AS (SELECT b.k, i.record_id, f.amount_text AS a, b.amt, b.q FROM base b JOIN ids i ON b.k = i.k JOIN feed f ON f.k = b.k AND f.engine_id = 'alpha' WHERE f.amount_text <> ''),
seg AS (SELECT *, 0 AS segment_index, trim(regexp_extract(a, '^[^(]*')) AS segment, amt AS num, CASE WHEN k % 8 = 2 THEN 'EUR' WHEN k % 8 = 4 THEN 'CRD' ELSE 'USD' END AS code FROM raw WHERE k % 8 <> 5
 UNION ALL SELECT *, 1, concat('reported equivalent USD 1,', q, '00.5'), concat('1,', q, '00.5'), 'USD' FROM raw WHERE k % 8 = 2),
price AS (SELECT k, record_id, concat('price_', substr(sha256(concat('["', record_id, '",', CAST(segment_index AS VARCHAR), ',"', segment, '","', code, '","', num, '"]')), 1, 24)) AS price_id, segment_index,
 CASE WHEN k % 8 = 2 THEN segment ELSE a END AS value_raw, CAST(replace(num, ',', '') AS DOUBLE) AS value_numeric, code AS currency_code, CASE WHEN k % 8 = 4 THEN 1000.0::DOUBLE ELSE 1.0::DOUBLE END AS scale_factor,
 CASE WHEN k % 8 = 3 THEN 'grouped_total' WHEN k % 8 IN (1, 7) THEN 'per_unit' ELSE 'unresolved' END AS basis, CASE WHEN k % 8 = 3 THEN '6 items' WHEN k % 8 IN (1, 7) THEN 'items' END AS denominator_unit,
 CASE WHEN segment_index = 1 THEN 'source_reported_conversion' ELSE 'original' END AS conversion_role,
 CASE WHEN k % 8 IN (0, 2, 4) THEN 'source expression does not state unit versus total' END AS unresolved_reason FROM seg
 UNION ALL SELECT k, record_id, concat('price_', substr(sha256(concat('["', record_id, '","', a, '","unresolved"]')), 1, 24)), NULL, a, NULL, NULL, NULL, 'unresolved', NULL, NULL, 'no configured currency/amount pattern matched' FROM raw WHERE k % 8 = 5)
"""
_PRICE_COLUMNS = ("record_id", "price_id", "segment_index", "value_raw", "value_numeric", "currency_code", "scale_factor", "basis", "denominator_unit", "conversion_role", "unresolved_reason")


def _prices(spark, sf_dir):
    """Prices of the records' amounts."""
    return enrich.prices(feeds.cells(spark, sf_dir), ROLES, PRICES)


@query(_PRICES + f"SELECT {', '.join(_PRICE_COLUMNS)} FROM price")
def price_long(spark, sf_dir):
    return _prices(spark, sf_dir).select(*_PRICE_COLUMNS)


@query("SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) AS value FROM orders", feed=False)
def numeric_text(spark, sf_dir):
    raw = F.format_number(F.col("o_totalprice").cast("decimal(18,2)"), 2)
    return table(spark, sf_dir, "orders").select("o_orderkey", numeric(raw).alias("value"))


# -- views, quality


@query("SELECT record_id, CASE WHEN bool_or(status IN ('conflict', 'missing')) THEN 'unresolved' WHEN bool_and(status = 'unanimous') THEN 'unanimous' ELSE 'majority' END AS record_status FROM cell GROUP BY record_id")
def record_status(spark, sf_dir):
    return enrich.record_status(feeds.cells(spark, sf_dir))


@query("""SELECT c.record_id, c.cell_id, c.field, CASE WHEN c.chosen IS NULL THEN 'null' WHEN c.chosen_t = 'str' THEN concat('"', c.chosen, '"') ELSE c.chosen END AS value_std, c.status,
concat('{', string_agg(concat('"', v.engine_id, '":', CASE WHEN v.t = 'str' THEN concat('"', v.raw, '"') ELSE v.raw END), ',' ORDER BY v.engine_id), '}') AS raw_by_engine_json
FROM cell c JOIN val v ON c.k = v.k AND c.field = v.field GROUP BY ALL""")
def cell_rows(spark, sf_dir):
    return enrich.cell_rows(feeds.cells(spark, sf_dir))


@query("SELECT record_id, " + ", ".join(f"max(chosen) FILTER (field = '{f}') AS {f}, max(status) FILTER (field = '{f}') AS {f}__status" for f in FIELDS) + " FROM cell GROUP BY record_id")
def wide_records(spark, sf_dir):
    return enrich.wide_rows(feeds.cells(spark, sf_dir), FIELDS).drop("document_id", "page_id", "table_id", "ordinal")


@query("""SELECT c.record_id, CAST(c.k AS VARCHAR) AS source_row_index, CAST(c.k // 50 AS VARCHAR) AS source_pdf_page_index,
CASE WHEN bool_or(status IN ('conflict', 'missing')) THEN 'unresolved' WHEN bool_and(status = 'unanimous') THEN 'unanimous' ELSE 'majority' END AS record_status,
max(chosen) FILTER (field = 'recorded_date') AS date_raw, CAST(max(chosen) FILTER (field = 'quantity') AS DOUBLE) AS quantity_numeric FROM cell c GROUP BY c.record_id, c.k""")
def published_records(spark, sf_dir):
    records, cells = feeds.written(spark, sf_dir)
    out = enrich.published_records(cells, records, ROLES, century=CENTURY, unicode_text=False)
    return out.select("record_id", "source_row_index", "source_pdf_page_index", "record_status", "date_raw", "quantity_numeric")


@query("SELECT count(*) AS total, count(*) FILTER (status IN ('conflict', 'missing')) AS unresolved, round(count(*) FILTER (status IN ('conflict', 'missing')) / count(*), 9) AS unresolved_rate FROM cell")
def status_summary(spark, sf_dir):
    return quality.status_summary(feeds.cells(spark, sf_dir)).withColumn("unresolved_rate", F.round("unresolved_rate", 9))


@query("SELECT engine_id, count(*) AS n_rows FROM feed GROUP BY engine_id")
def rows_by_engine(spark, sf_dir):
    return quality.rows_by_engine(feeds.records(spark, sf_dir))


@query("SELECT 1.0::DOUBLE AS provenance_completeness")
def provenance_completeness(spark, sf_dir):
    return quality.provenance_completeness(feeds.records(spark, sf_dir))


@query(_PRICES + """, cand AS (SELECT c.record_id FROM cell c WHERE c.field = 'item_name' AND c.status = 'conflict')
SELECT (SELECT count(*) FROM ids) AS aligned_records, (SELECT count(*) FROM ids WHERE k % 11 = 3 OR k % 13 = 5) AS missing_source_rows, (SELECT count(*) FROM cell) AS total,
(SELECT count(*) FROM cell WHERE status IN ('conflict', 'missing') AND NOT (status = 'conflict' AND field = 'item_name')) AS unresolved, (SELECT count(*) FROM cand) AS cell_decisions,
(SELECT count(*) FROM price) AS price_observations, (SELECT count(*) FROM price WHERE unresolved_reason IS NOT NULL) AS unresolved_price_observations, 'CRD,EUR,USD' AS currencies""")
def quality_summary(spark, sf_dir):
    records, cells = feeds.written(spark, sf_dir)
    decided = review.apply_decisions(cells, _decisions(cells), check=False)
    out = quality.quality_summary(records, decided, enrich.prices(cells, ROLES, PRICES), ENGINES)
    return out.select("aligned_records", "missing_source_rows", "total", "unresolved", "cell_decisions", "price_observations", "unresolved_price_observations", "currencies")


@query("SELECT 'unresolved' AS check_name, count(*) AS n FROM cell WHERE status IN ('conflict', 'missing') UNION ALL SELECT 'fields_missing', count(*) FROM ids")
def validation_report(spark, sf_dir):
    records, cells = feeds.written(spark, sf_dir)
    found = quality.violations(records, cells, [*FIELDS, "never"])
    return found.groupBy("check_name").agg(F.count("*").alias("n"))


@query("SELECT o_custkey, count(*) AS n, round(1 - pow(0.05, 1.0 / count(*)), 9) AS bound FROM orders GROUP BY o_custkey", feed=False)
def zero_error_bound(spark, sf_dir):
    n = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return n.withColumn("bound", F.round(quality.zero_error_upper_bound(F.col("n")), 9))


@query(" UNION ALL ".join(f"SELECT doc_id, '{name}' AS finding FROM documents WHERE regexp_matches(text, '{p.replace(chr(39), chr(39) * 2)}')" for name, p in secrets.PATTERNS.items()), feed=False)
def secret_scan(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("SELECT engine_id, k, row_number() OVER (PARTITION BY engine_id ORDER BY k) AS n FROM feed")
def stream_position(spark, sf_dir):
    """Places within blocks of a stream, then what the blocks before hold: no stream is in one task."""
    rows = feeds.engine_rows(spark, sf_dir).select("engine_id", "pos", _k().alias("k"), F.floor(F.col("pos") / 65536).alias("block"))
    before = Window.partitionBy("engine_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("engine_id", "block").agg(F.count("*").alias("size")).select("engine_id", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    placed = rows.withColumn("place", F.row_number().over(Window.partitionBy("engine_id", "block").orderBy("pos")))
    return placed.join(blocks, ["engine_id", "block"]).select("engine_id", "k", (F.col("place") + F.col("before")).cast("long").alias("n"))


# -- planted violations: every check fires


@query("""SELECT 'duplicate_record_id' AS check_name, count(*) FILTER (k % 50 = 1) AS n FROM ids UNION ALL SELECT 'anchor_not_unique', count(*) FILTER (k % 50 = 2) FROM ids
UNION ALL SELECT 'record_id_mismatch', count(*) FILTER (k % 50 = 3) FROM ids UNION ALL SELECT 'engine_twice', count(*) FILTER (k % 50 = 4) FROM ids
UNION ALL SELECT 'several_physical_pages', count(*) FILTER (k % 50 = 5 AND NOT (k % 11 = 3 AND k % 13 = 5)) FROM ids UNION ALL SELECT 'several_printed_labels', count(*) FILTER (k % 50 = 6 AND NOT (k % 11 = 3 AND k % 13 = 5)) FROM ids
UNION ALL SELECT 'page_index_missing', count(*) FROM feed WHERE k % 50 = 7
UNION ALL SELECT 'fields_missing', count(*) FILTER (k % 50 IN (3, 8)) FROM ids UNION ALL SELECT 'fields_undeclared', count(*) FILTER (k % 50 = 9) FROM ids
UNION ALL SELECT 'duplicate_cell_id', count(*) FILTER (k % 50 = 10) FROM ids UNION ALL SELECT 'duplicate_candidate_id', (SELECT count(*) FROM feed WHERE k % 50 = 10)
UNION ALL SELECT 'unresolved', count(*) FILTER (status IN ('conflict', 'missing') AND NOT (k % 50 = 8 AND field = 'note')) + count(*) FILTER (status IN ('conflict', 'missing') AND k % 50 = 10 AND field = 'item_name') FROM cell""")
def validation_checks(spark, sf_dir):
    """Records and cells with one thing wrong in each of some places; what the checks find, counted."""
    records = materialize(feeds.records(spark, sf_dir), "records")
    cells = materialize(feeds.cells_of(records), "cells")
    k = F.get("members", F.lit(0))["row_index"]["s"].cast("long") % 50
    number = lambda s: F.struct(F.lit("int").alias("t"), s.cast("string").alias("s"))
    last = F.size("members") - 1
    changed = F.transform(
        "members",
        lambda m, i: m.withField("page_index", F.when(k == 7, F.lit(None).cast("struct<t:string,s:string>")).when((k == 5) & (i == last) & (i > 0), number(F.lit(-5))).otherwise(m["page_index"]))
        .withField("printed_page_label", F.when((k == 6) & (i <= 1), i.cast("string")).otherwise(m["printed_page_label"])),
    )
    # the engine that comes twice is never the anchor: where a record has no other source, another engine's are put in
    lone = F.transform(F.array_repeat(F.get("changed", F.lit(0)), 2), lambda m: m.withField("engine_id", F.lit("beta")))
    again_there = F.when(last == 0, lone).otherwise(F.slice("changed", -1, 1))
    names = ["record_id", "document_id", "page_id", "table_id", "ordinal", "anchor_engine_id", "members"]
    wrong = records.withColumn("k", k).withColumn("changed", changed).select(
        F.when(F.col("k") == 3, F.concat(F.lit("rec_x"), "record_id")).otherwise(F.col("record_id")).alias("record_id"), "document_id", "page_id", "table_id", "ordinal",
        F.when(F.col("k") == 2, "nobody").otherwise(F.col("anchor_engine_id")).alias("anchor_engine_id"),
        F.when(F.col("k") == 4, F.concat("changed", again_there)).otherwise(F.col("changed")).alias("members"), "k",
    )
    # the id covers the anchor's page, so those rows' ids are made again
    from ..functions.typed import record_id

    anchor = F.get(F.filter("members", lambda m: m["engine_id"] == "alpha"), F.lit(0))
    made = record_id(F.col("document_id"), F.col("page_id"), F.col("table_id"), F.lit("alpha"), scalar_json(anchor["row_index"]), scalar_json(anchor["page_index"]))
    again = wrong.withColumn("record_id", F.when((F.col("k") == 7) | ((F.col("k") == 5) & (F.size("members") == 1)), made).otherwise(F.col("record_id")))
    more = again.where("k = 1").select(*names)
    at = cells.join(records.select("record_id", k.alias("k")), "record_id")
    renamed = at.join(again.select(F.col("document_id").alias("d"), F.col("page_id").alias("p"), F.col("ordinal").alias("o"), F.col("record_id").alias("new_id"), F.col("k").alias("nk")).where("nk = 7 OR nk = 5"),
                      (F.col("document_id") == F.col("d")) & (F.col("page_id") == F.col("p")) & (F.col("ordinal") == F.col("o")), "left")
    fitted = renamed.withColumn("record_id", F.coalesce("new_id", "record_id")).drop("d", "p", "o", "new_id", "nk")
    lost = fitted.where("NOT (k = 8 AND field = 'note')")
    extra = fitted.where("k = 9 AND field = 'note'").withColumns({"field": F.lit("other"), "cell_id": F.concat("cell_id", F.lit("-o")), "status": F.lit("unanimous"), "candidates": F.filter("candidates", lambda c: F.lit(False))})
    twice = fitted.where("k = 10 AND field = 'item_name'")
    found = quality.violations(again.select(*names).unionByName(more), lost.unionByName(extra).unionByName(twice).drop("k"), FIELDS, page_index_required=True)
    return found.groupBy("check_name").agg(F.count("*").alias("n"))


@query("""SELECT 'foreign_candidate' AS violation, count(*) AS n FROM cell WHERE status = 'conflict' AND field = 'item_name' AND k % 3 = 0
UNION ALL SELECT 'value_mismatch', count(*) FROM cell WHERE status = 'conflict' AND field = 'item_name' AND k % 3 = 1""")
def decision_candidate_violations(spark, sf_dir):
    """Decisions that name a candidate of another cell, and a value that isn't their candidate's."""
    found, cells = feeds.written(spark, sf_dir)
    first = F.get("candidates", F.lit(0))
    records = found.select("record_id", F.get("members", F.lit(0))["row_index"]["s"].cast("long").alias("k"))
    own = cells.where("status = 'conflict' AND field = 'item_name'").join(records, "record_id")
    nothing = F.lit(None).cast("string")
    made = own.select(
        "cell_id", F.when(F.col("k") % 3 == 1, F.struct(F.lit("int").alias("t"), F.lit("1").alias("s"))).otherwise(first["value"]).alias("chosen"),
        F.when(F.col("k") % 3 == 0, F.concat(F.lit("cand_of_"), "cell_id")).otherwise(first["candidate_id"]).alias("candidate_id"), F.lit("seen").alias("reason"), F.lit("r").alias("reviewer"),
        F.lit("2024-01-01").alias("decided_at"), nothing.alias("decision_id"), nothing.alias("source_decision_id"),
    )
    return review.decision_violations(made, cells).groupBy("violation").agg(F.count("*").alias("n"))


@query("""SELECT violation, count(*) AS n FROM (
SELECT CASE WHEN k % 12 = 0 THEN 'not_approved' WHEN k % 12 = 1 THEN 'unknown_row' WHEN k % 12 = 2 THEN 'unknown_field' WHEN status IN ('unanimous', 'majority') THEN 'already_resolved'
 WHEN k % 12 = 3 THEN 'no_single_candidate' WHEN k % 12 = 4 THEN 'value_mismatch' WHEN k % 12 = 5 THEN 'engines_mismatch' WHEN k % 12 = 6 THEN 'values_mismatch' WHEN k % 12 = 7 THEN 'reviewer_required'
 WHEN k % 12 = 8 THEN 'decided_at_required' WHEN k % 12 = 9 THEN 'rationale_required' END AS violation FROM cell WHERE field = 'item_name') WHERE violation IS NOT NULL GROUP BY violation""")
def compile_violations(spark, sf_dir):
    """Events with one thing wrong in each, as the compiler names it."""
    records, cells = feeds.written(spark, sf_dir)
    events = _events(spark, records, "choose_candidate", ["item_name"])
    k = F.col("_k") % 12
    other = F.struct(F.lit("str").alias("t"), F.lit("never").alias("s"))
    nothing = F.lit(None).cast("string")
    wrong = events.withColumns(
        {
            "status_event": F.when(k == 0, "pending").otherwise(F.col("status_event")), "page_id": F.when(k == 1, "nowhere").otherwise(F.col("page_id")), "field": F.when(k == 2, "nothing").otherwise(F.col("field")),
            "raw": F.when(k == 3, other).otherwise(F.col("raw")), "value": F.when(k == 4, other).otherwise(F.col("value")), "engine_ids": F.when(k == 5, F.array(F.lit("alpha"), F.lit("delta"))).otherwise(F.col("engine_ids")),
            "raw_values": F.when(k == 6, F.array(F.lit('"never"'))).otherwise(F.col("raw_values")), "reviewer": F.when(k != 7, "r").otherwise(nothing), "decided_at": F.when(k != 8, "now").otherwise(nothing),
            "rationale": F.when(k == 9, " ").otherwise(F.col("rationale")),
        }
    )
    made = decisions.compile_choose(wrong.drop("_k"), records, cells)
    return made.where("violation IS NOT NULL").groupBy("violation").agg(F.count("*").alias("n"))


# -- scalars and JSON


@query("""SELECT concat('{"o_custkey":', o_custkey, ',"o_orderdate":"', CAST(o_orderdate AS VARCHAR), '","o_orderkey":', o_orderkey, ',"o_orderpriority":"', o_orderpriority, '","o_orderstatus":"', o_orderstatus,
'","o_totalprice":', CAST(o_totalprice AS VARCHAR), '}') AS value FROM orders""", feed=False)
def canonical_jsonl_rows(spark, sf_dir):
    names = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    return sinks.json_lines(table(spark, sf_dir, "orders").select(*names))


@query(f"SELECT conv_id, turn, nullif(regexp_replace(text, '^{_BLANK}|{_BLANK}$', '', 'g'), '') AS value FROM conversations", feed=False)
def scalar_text(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return rows.select("conv_id", "turn", enrich.scalar_text(F.struct(F.lit("str").alias("t"), F.col("text").alias("s"))).alias("value"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber IN (1, 7) THEN NULL ELSE CAST(l_linenumber AS VARCHAR) END AS line, CASE WHEN l_quantity IN (1, 7) THEN NULL ELSE CAST(CAST(l_quantity AS DECIMAL(18, 1)) AS VARCHAR) END AS quantity,
CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_returnflag END AS flag, CASE WHEN l_linestatus <> 'F' THEN 'false' END AS open FROM lineitem""", feed=False)
def missing_sentinel_typed(spark, sf_dir):
    """Sentinels of all types: 1 (and so 1.0 and true), 7.0 (and so 7) and a text."""
    rule = Rule(transforms=(), missing=(1, 7.0, "R"))
    of = lambda kind, text: rule.apply(F.struct(F.lit(kind).alias("t"), text.cast("string").alias("s")))["s"]
    rows = table(spark, sf_dir, "lineitem")
    return rows.select(
        "l_orderkey", "l_linenumber", of("int", F.col("l_linenumber")).alias("line"), of("float", F.col("l_quantity").cast("decimal(18,1)")).alias("quantity"), of("str", F.col("l_returnflag")).alias("flag"),
        of("bool", F.col("l_linestatus") == "F").alias("open"),
    )


_WIDE_DIGITS = "０１２３４５６７８９"


@query("SELECT o_orderkey, substr(CAST(o_orderdate AS VARCHAR), 1, 7) AS date_start, 'month' AS date_precision FROM orders", feed=False)
def date_unicode(spark, sf_dir):
    """Dates in full-width digits, by way of compatibility folding."""
    wide = F.translate(F.substring(F.col("o_orderdate").cast("string"), 1, 7), "0123456789", _WIDE_DIGITS)
    return table(spark, sf_dir, "orders").select("o_orderkey", parse_date(wide).alias("d")).select("o_orderkey", "d.date_start", "d.date_precision")


# -- artifacts: what is written is read back


@query("SELECT engine_id, CAST(k AS VARCHAR) AS row_index, item_name, quantity, quantity_t AS quantity_type, amount_text, note FROM feed")
def read_back_rows(spark, sf_dir):
    """The feed as JSON lines of three files, read as engines' rows: lines, aliases, typed scalars."""
    rows = feeds.engine_rows(spark, sf_dir).drop("row_uid", "pos").withColumnsRenamed({"engine_id": "engine", "row_index": "source_row", "page_index": "source_pdf_page_index"})
    paths = []
    for e in ENGINES:
        paths.append(new_path(spark, f"rows-{e}"))
        sinks.write_jsonl(rows.where(F.col("engine") == e), paths[-1], ["page_id", "source_row"])
    read = jsonl.read_rows(spark, paths).where("problem IS NULL")
    cell = F.col("cells")
    return read.select(
        "engine_id", F.col("row_index.s").alias("row_index"), cell["item_name"]["s"].alias("item_name"), cell["quantity"]["s"].alias("quantity"), cell["quantity"]["t"].alias("quantity_type"), cell["amount_text"]["s"].alias("amount_text"),
        cell["note"]["s"].alias("note"),
    )


@query("""SELECT c.record_id, c.cell_id, c.field, c.status, c.chosen_t, c.chosen, concat_ws(',', CASE WHEN c.k % 11 = 3 THEN 'beta' END, CASE WHEN c.k % 13 = 5 THEN 'gamma' END) AS missing,
CAST(1 + CASE WHEN c.k % 11 <> 3 THEN 1 ELSE 0 END + CASE WHEN c.k % 13 <> 5 THEN 1 ELSE 0 END AS INT) AS n_candidates FROM cell c""")
def consensus_reload(spark, sf_dir):
    """Consensus as JSON lines, and read back."""
    records = materialize(feeds.records(spark, sf_dir), "records")
    cells = materialize(feeds.cells_of(records), "cells")
    path = new_path(spark, "consensus")
    artifacts.consensus_lines(records, cells, list(ENGINES)).write.text(path)
    _, again = artifacts.load_consensus(spark, path)
    return again.select(
        "record_id", "cell_id", "field", "status", F.col("chosen.t").alias("chosen_t"), F.col("chosen.s").alias("chosen"), F.array_join("missing_engine_ids", ",").alias("missing"),
        F.size("candidates").alias("n_candidates"),
    )


@query("""SELECT c.cell_id, a.s AS chosen, 'seen' AS reason, 'r' AS reviewer, '2024-01-01' AS decided_at FROM cell c JOIN val a ON a.k = c.k AND a.field = c.field AND a.engine_id = 'alpha'
WHERE c.status = 'conflict' AND c.field = 'item_name'""")
def decisions_reload(spark, sf_dir):
    """Decisions as JSON lines, and read back."""
    path = new_path(spark, "decisions")
    artifacts.decision_lines(_decisions(feeds.cells(spark, sf_dir))).write.text(path)
    return artifacts.read_decisions(spark, path).select("cell_id", F.col("chosen.s").alias("chosen"), "reason", "reviewer", "decided_at")


_ANSWER = {"profile_version": "1", "name": "n", "record_type": "r", "fields": [{"name": "name"}, {"name": "segment"}, {"name": "balance"}]}


@query("""SELECT CAST(c_custkey AS VARCHAR) AS key, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(0 AS BIGINT) END AS row_index, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE 'main' END AS table_id,
CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_name END AS name, CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS segment, c_custkey % 10 = 0 AS refused FROM customer""", feed=False)
def transcription_rows(spark, sf_dir):
    """Answers of a transcriber, some fenced and some with fields that are not declared, as rows."""
    c = table(spark, sf_dir, "customer")
    cells = F.concat(F.lit('{"name":"'), F.col("c_name"), F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.concat(F.lit('","segment":"'), F.col("c_mktsegment"))), F.when(F.col("c_custkey") % 10 == 0, '","other":"x').otherwise(""), F.lit('"}'))
    text = F.concat(F.lit('{"rows":[{"cells":'), cells, F.lit("}]}"))
    fenced = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("```json\n"), text, F.lit("\n```"))).otherwise(text)
    rows = transcription.response_rows(c.select("c_custkey", fenced.alias("text")), parse_profile(_ANSWER), "c_custkey")
    return rows.select("key", "row_index", "table_id", F.col("cells")["name"]["s"].alias("name"), F.col("cells")["segment"]["s"].alias("segment"), F.col("problem").isNotNull().alias("refused"))


@query(_PRICES + """SELECT c.record_id, CASE WHEN bool_or(c.status IN ('conflict', 'missing')) THEN 'unresolved' WHEN bool_and(c.status = 'unanimous') THEN 'unanimous' ELSE 'majority' END AS record_status,
max(concat('{"cell_id":"', c.cell_id, '","raw":{', r.raw, '},"status":"', c.status, '","std":', CASE WHEN c.chosen IS NULL THEN 'null' ELSE concat('"', c.chosen, '"') END, '}')) FILTER (c.field = 'item_name') AS item,
max(concat('{"cell_id":"', c.cell_id, '","raw":{', r.raw, '},"status":"', c.status, '","std":', coalesce(c.chosen, 'null'), '}')) FILTER (c.field = 'quantity') AS quantity,
max(coalesce(p.ids, '[]')) AS price_ids FROM cell c
JOIN (SELECT k, field, string_agg(concat('"', engine_id, '":', CASE WHEN t = 'str' THEN concat('"', raw, '"') ELSE raw END), ',' ORDER BY engine_id) AS raw FROM val GROUP BY k, field) r ON r.k = c.k AND r.field = c.field
LEFT JOIN (SELECT record_id, concat('["', string_agg(price_id, '","' ORDER BY segment_index), '"]') AS ids FROM price GROUP BY record_id) p ON p.record_id = c.record_id GROUP BY c.record_id""")
def research_records(spark, sf_dir):
    """Research views: the JSON of some fields, and the ids of prices in the amount's."""
    records, cells = feeds.written(spark, sf_dir)
    views = enrich.research_views(cells, records, FIELDS, ROLES, enrich.prices(cells, ROLES, PRICES), century=CENTURY)
    one = lambda f: F.col("fields")[f]["json"]
    return views.select("record_id", "record_status", one("item_name").alias("item"), one("quantity").alias("quantity"), F.get_json_object(one("amount_text"), "$.std").alias("price_ids"))
