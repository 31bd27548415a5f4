"""Reconciliation: golden ids and statuses of a small two-engine case, properties, and the queries against SQL."""

import hashlib
import itertools
import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import dates, prices, text, typed
from tallyframe.operators import admission, align, consensus, review
from tallyframe.operators.normalize import Normalization, Rule, normalized_rows
from tallyframe.plans.reconcile import publish, reconcile_files
from tallyframe.sources import jsonl
from tallyframe.sources.profile import ProfileError, parse_profile

PROFILE = {
    "profile_version": "1", "name": "test", "record_type": "row",
    "fields": [{"name": "code"}, {"name": "name"}, {"name": "day", "semantic_role": "date"}, {"name": "cost", "semantic_role": "amount"}],
    "alignment": {"weights": {"code": 0.6, "name": 0.4}, "anchor_engine": "a"},
    "comparison_normalization": {"default": ["nfkc", "strip", "collapse_whitespace"], "fields": {"code": {"transforms": ["strip", "upper"]}}},
    "normalization": {"dates": {"two_digit_century": 2000}, "amounts": {"currency_aliases": {"USD": ["USD"], "EUR": "EUR"}, "scale_factors": {"thousand": 1000}}},
}


def line(engine, k, **cells):
    return json.dumps({"document": "d", "page": "p", "table": "t", "engine": engine, "engine_version": "1", "row_index": k, "source_pdf_page_index": 0, "cells": {"code": f"C{k}", "name": "x", "day": "07.4", "cost": "USD 5"} | cells})


def test_ids(spark):
    parts = ["synthetic-archive-001", "synthetic-page-a", "synthetic-table-a", "ocr-alpha", 0, 0]
    made = typed.record_id(*[F.lit(p) for p in parts[:4]], F.lit("0"), F.lit("0"))
    row = spark.range(1).select(made.alias("r"), typed.cell_id(made, F.lit("item_name")).alias("c")).first()
    assert (row.r, row.c) == ("rec_41b414677e5e682bdde1eaa4", "cell_200c2fb8b8dceabbf9dd6dab")
    odd = 'a"\\\n\t\x01\x1f é 😀 /'
    assert spark.createDataFrame([(odd,)], "s string").select(typed.quoted(F.col("s")).alias("q")).first().q == json.dumps(odd, ensure_ascii=False)
    want = "x_" + hashlib.sha256(json.dumps([odd, None], ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()[:24]
    assert spark.createDataFrame([(odd,)], "s string").select(typed.stable_id("x", [typed.text_json(F.col("s")), F.lit("null")]).alias("q")).first().q == want


def test_text(spark):
    rnd = random.Random(1)
    samples = ["".join(rnd.choice(" \t\x1c 　aé‐−Ａﬁß1") for _ in range(rnd.randint(0, 9))) for _ in range(300)]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = df.select("s", *[text.TRANSFORMS[n](F.col("s")).alias(n) for n in ("strip", "collapse_whitespace", "remove_whitespace", "normalize_dashes", "nfkc", "casefold")]).collect()
    import unicodedata

    for r in got:
        assert r.strip == r.s.strip() and r.collapse_whitespace == " ".join(r.s.split()) and r.remove_whitespace == "".join(r.s.split())
        assert r.nfkc == unicodedata.normalize("NFKC", r.s) and r.casefold == r.s.casefold()
        assert r.normalize_dashes == r.s.translate({c: "-" for c in (0x2010, 0x2011, 0x2012, 0x2013, 0x2014, 0x2212)})


def test_canonical_number(spark):
    want = {"007": "7", "+5": "5", ".50": "0.5", "5.": "5", "-0": "0", "1,2,3": "123", "1e3": "1e3", "-1.250": "-1.25", "x": "x", "": "", " 42 ": "42", "0.0": "0"}
    got = spark.createDataFrame([(k,) for k in want], "s string").select("s", text.canonical_number(F.col("s")).alias("n")).collect()
    assert {r.s: r.n for r in got} == want


def test_natural_order(spark):
    names = ["page-b", "page-10", "page-2", "Page-1", "2", "10"]
    got = [r.s for r in spark.createDataFrame([(n,) for n in names], "s string").orderBy(text.natural_key(F.col("s"))).collect()]
    assert got == ["2", "10", "Page-1", "page-2", "page-10", "page-b"]


def test_dates(spark):
    want = {
        "07.4": ("2007-04", "2007-04", "month"), "2008 (batch one) 2009 (batch two)": ("2008", "2009", "range_year"), "1998-13": (None, None, "unresolved"),
        "": (None, None, "missing"), "none": (None, None, "unresolved"), "12345": ("1234", "1234", "year"), "2001-04 to 2003": ("2001-04", "2003", "range_month"), "２００１": ("2001", "2001", "year"),
    }
    got = spark.createDataFrame([(k,) for k in want], "s string").select("s", dates.parse_date(F.col("s"), century=2000).alias("d")).collect()
    assert {r.s: (r.d.date_start, r.d.date_end, r.d.date_precision) for r in got} == want
    one = spark.createDataFrame([("07.4",)], "s string").select(dates.parse_date(F.col("s")).alias("d")).first().d
    assert one.unresolved_reason == dates.NO_CENTURY


def test_prices(spark):
    config = prices.PriceConfig(currency_aliases={"CRD": ["CR"], "TOK": ["TK"], "USD": ["USD"]}, scale_factors={"thousand": 1000})
    df = spark.createDataFrame(
        [("r1", "CR 8.37 thousand (reported equivalent TK 4.25 thousand)", None), ("r2", "TK 315750 (6 records total)", None), ("r3", "17.5", "USD per item"), ("r4", "nothing", None), ("r5", " ", "USD")], "r string, a string, u string"
    )
    got = prices.price_rows(df, F.col("a"), F.col("u"), F.col("r"), config).orderBy("r", "segment_index").collect()
    assert [(x.r, x.value_numeric, x.currency_code, x.scale_factor, x.basis, x.denominator_unit, x.conversion_role) for x in got] == [
        ("r1", 8.37, "CRD", 1000.0, "unresolved", None, "original"), ("r1", 4.25, "TOK", 1000.0, "unresolved", None, "source_reported_conversion"),
        ("r2", 315750.0, "TOK", 1.0, "grouped_total", "6 items", "original"), ("r3", 17.5, "USD", 1.0, "per_unit", "item", "original"), ("r4", None, None, None, "unresolved", None, None),
    ]


@pytest.mark.parametrize(
    ("values", "expected", "status", "chosen"),
    [
        ([], 2, "missing", None), ([None], 1, "unanimous", None), ([None], 2, "missing", None), ([None, None], 2, "unanimous", None), (["a"], 1, "unanimous", "a"), (["a"], 2, "missing", "a"),
        (["a", None], 2, "missing", "a"), (["a", "a"], 5, "unanimous", "a"), (["a", "b"], 2, "conflict", None), (["a", "a", "b"], 5, "majority", "a"), (["a", "a", "b", "b"], 4, "conflict", None),
        (["a", "a", "b", "c"], 4, "conflict", None), ([1, "1"], 2, "conflict", None), ([1, 1.0], 2, "conflict", None),
    ],
)
def test_votes(spark, values, expected, status, chosen):
    scalars = [jsonl.scalar(v) for v in values]
    df = spark.createDataFrame([(scalars,)], "_values array<struct<t:string,s:string>>")
    got = consensus.with_votes(df, expected, consensus.ConsensusConfig()).first()
    assert (got.status, got.chosen and got.chosen.s) == (status, chosen)


def brute_alignment(a, b, same, gap=-0.4, mismatch=-0.85):
    """Best score over all global alignments."""
    best = -1e9
    for k in range(min(len(a), len(b)) + 1):
        for x in itertools.combinations(range(len(a)), k):
            for y in itertools.combinations(range(len(b)), k):
                score = gap * (len(a) + len(b) - 2 * k) + sum(s if (s := same(a[i], b[j])) >= 0.45 else mismatch for i, j in zip(x, y))
                best = max(best, score)
    return best


def test_alignment_is_optimal():
    rnd = random.Random(7)
    for _ in range(40):
        rows = lambda: [{"n": ("str", "".join(rnd.choice("ab") for _ in range(4)))} for _ in range(rnd.randint(1, 4))]
        a, b = rows(), rows()
        aligner = align.SectionAligner(align.AlignmentConfig(anchor_engine="a"))
        groups = aligner.align({"a": list(a), "b": list(b)})
        score = sum(aligner.increment([g[0]], g[1]) if len(g) == 2 else -0.4 for g in groups)
        assert score == pytest.approx(brute_alignment(a, b, aligner.row_similarity))
        assert [r for g in groups for r in g[:1] if any(r is x for x in a)] == a


def test_files_to_publication(spark, tmp_path):
    a, b = tmp_path / "a.jsonl", tmp_path / "b.jsonl"
    a.write_text("﻿" + "\n\n".join(line("a", k) for k in range(4)) + "\n")
    b.write_text("\n".join([line("b", 0, code=" c0 "), line("b", 1, name="y"), line("b", 3, cost="EUR 7 total")]))
    profile = parse_profile(PROFILE)
    found = reconcile_files(spark, [str(a), str(b)], profile)
    cells = found.cells.cache()
    assert cells.count() == 16
    status = {(r.ordinal, r.field): r.status for r in cells.collect()}
    assert status[1, "code"] == "unanimous" and status[2, "name"] == "conflict" and status[3, "code"] == "missing" and status[4, "cost"] == "conflict"
    with pytest.raises(ValueError, match="unresolved"):
        publish(found, profile, str(tmp_path / "out"))
    queue = found.review_queue()
    assert queue.count() == 6
    first = F.get("candidates", F.lit(0))
    nothing = F.lit(None).cast("string")
    decided = queue.select("cell_id", first["value"].alias("chosen"), first["candidate_id"].alias("candidate_id"), F.lit("read").alias("reason"), F.lit("r").alias("reviewer"), F.lit("now").alias("decided_at"), nothing.alias("decision_id"), nothing.alias("source_decision_id"))
    done = found.decided(decided)
    summary = publish(done, profile, str(tmp_path / "out"))
    assert (summary["unresolved"], summary["cell_decisions"], summary["aligned_records"], summary["provenance_completeness"]) == (0, 6, 4, 1.0)
    assert {r.status for r in done.cells.where("decision IS NOT NULL").collect()} == {"conflict", "missing"}
    assert spark.read.parquet(str(tmp_path / "out/records")).where("date_start = '2007-04'").count() == 4
    with pytest.raises(review.DecisionApplyError, match="duplicate"):
        found.decided(decided.union(decided))
    with pytest.raises(review.DecisionApplyError, match="unknown_cell"):
        found.decided(decided.withColumn("cell_id", F.lit("cell_none")).limit(1))


def test_contract_errors(spark, tmp_path):
    bad = tmp_path / "bad.jsonl"
    bad.write_text(line("a", 1) + "\n[1]\n" + '{"cells": {}}\n')
    with pytest.raises(jsonl.DataContractError, match="line 2: not a JSON object"):
        jsonl.check_rows(jsonl.read_rows(spark, [str(bad)]))
    twice = tmp_path / "twice.jsonl"
    twice.write_text("\n".join([line("a", 1), line("a", 1), line("b", 1)]))
    with pytest.raises(admission.AdmissionError, match="duplicate_identity"):
        reconcile_files(spark, [str(twice)], parse_profile(PROFILE))
    with pytest.raises(ProfileError, match="duplicate"):
        parse_profile(PROFILE | {"fields": [{"name": "a"}, {"name": "a"}], "alignment": {}})
    for wrong in ({"majority_fraction": 0.4}, {"minimum_majority_votes": 0}):
        with pytest.raises(ValueError):
            consensus.ConsensusConfig(**wrong)


def test_rules(spark):
    rule = Rule(transforms=("strip", "canonical_number"), replacements={"n/a": ""}, missing=("", "-"))
    df = spark.createDataFrame([("u", {"x": jsonl.scalar(v)}) for v in (" 007 ", 7, "n/a", "-", True, None)], "row_uid string, cells map<string,struct<t:string,s:string>>")
    got = normalized_rows(df, ["x"], Normalization(default=rule)).select(F.col("norm")["x"]["value"].alias("v")).collect()
    assert [r.v and tuple(r.v) for r in got] == [("str", "7"), ("str", "7"), None, None, ("bool", "true"), None]


QUICK = ("consensus_cells", "normalize_text", "canonical_number", "date_century", "price_long", "align_exact_key", "secret_scan", "record_status", "admission_violations")


@pytest.mark.parametrize("name", QUICK)
def test_query_matches_sql(spark, data, name):
    import duckdb

    from tallyframe.plans.queries import QUERIES, SQL

    con = duckdb.connect()
    for t in ("orders", "customer", "lineitem", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    df = QUERIES[name](spark, data)
    names = sorted(df.columns)
    theirs = con.execute(SQL[name])
    at = [[d[0] for d in theirs.description].index(n) for n in names]
    plain = lambda v: float(v) if isinstance(v, Decimal) else v
    want = sorted((tuple(plain(r[i]) for i in at) for r in theirs.fetchall()), key=repr)
    assert sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr) == want


@pytest.mark.parametrize("name", ("alias_collisions", "event_locator", "stream_position", "natural_section_order"))
def test_whole_query_matches_sql(spark, data, name):
    """All of the feed."""
    test_query_matches_sql(spark, data, name)
    from tallyframe.plans import feeds
    from tallyframe.plans.queries import QUERIES

    rows = feeds.engine_rows(spark, data)
    whole = {"event_locator": rows.where("engine_id = 'alpha'").count() + 1, "natural_section_order": rows.select("page_id").distinct().count()}
    assert QUERIES[name](spark, data).count() == whole.get(name, rows.count())


def test_whitespace_of_all_conversations(spark, data, tmp_path):
    """All rows, those beyond ASCII too, as Python's str methods and as the SQL of the query."""
    import duckdb

    from tallyframe.plans.queries import QUERIES, SQL

    blanks = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    odd = [(-1, k, "user", f"{b}é{b}{b}x {b}") for k, b in enumerate([*blanks, "\u200b", "\ufeff", "\u180e"])] + [(-1, 99, "user", None)]
    table = spark.read.parquet(f"{data}/conversations.parquet")
    both = table.select("conv_id", "turn", "role", "text").unionByName(spark.createDataFrame(odd, "conv_id long, turn long, role string, text string"))
    both.coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    rows = {(r.conv_id, r.turn, r.collapsed, r.removed) for r in QUERIES["normalize_whitespace"](spark, str(tmp_path)).collect()}
    want = {(r.conv_id, r.turn, r.text and " ".join(r.text.split()), r.text and "".join(r.text.split())) for r in both.collect()}
    assert rows == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert set(con.execute(SQL["normalize_whitespace"]).fetchall()) == want


def test_planted_violations_of_lone_anchors(spark, tmp_path):
    """Records with no source but the anchor, at every place where something is planted, against the SQL of the query."""
    import datetime
    import decimal

    import duckdb

    from tallyframe.plans.queries import QUERIES, SQL

    lone = [k for k in range(7150) if k % 11 == 3 and k % 13 == 5]  # a k for every remainder of 50
    orders = [(k, 1, datetime.date(1995, 3, 1), decimal.Decimal("10.50"), "5-LOW") for k in sorted({*lone, *range(1, 200)})]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate date, o_totalprice decimal(15,2), o_orderpriority string").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, "Customer#1")], "c_custkey long, c_name string").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    assert {k % 50 for k in lone} == set(range(50))
    con = duckdb.connect()
    for name in ("orders", "customer"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    got = {tuple(r) for r in QUERIES["validation_checks"](spark, str(tmp_path)).collect()}
    assert got == set(con.execute(SQL["validation_checks"]).fetchall())
