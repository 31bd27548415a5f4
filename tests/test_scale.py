"""What keeps the cost of large tables down: generated code that the JVM compiles, votes counted once, joins without what they don't read."""

import re

from pyspark.sql import functions as F

from tallyframe.functions import text
from tallyframe.operators import decisions
from tallyframe.operators.normalize import normalized_rows
from tallyframe.plans import feeds, queries


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_normalisation_is_compiled(spark, data):
    """The JVM interprets methods of more than 8000 bytes of code, at some thirty times the cost."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # whose plans have no code until they run
    try:
        df = normalized_rows(feeds.engine_rows(spark, data), feeds.FIELDS, feeds.NORMALIZATION)
        parts = df._jdf.queryExecution().debug().codegenToSeq()
        sizes = [parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sizes and max(sizes) <= 8000, sizes
    assert "StartsWith(" in plan(df)  # tidy text skips the regular expressions


def test_votes_are_counted_below_filters(spark, data):
    cells = feeds.cells(spark, data).where("status = 'conflict' AND field = 'item_name'").select("cell_id", "candidates")
    filters = re.findall(r"Filter .*", plan(cells))
    assert filters and not any("array_distinct" in f or "lambdafunction" in f for f in filters if "status" in f or "conflict" in f)
    assert sum("lambdafunction" in f for f in re.findall(r"Filter .*", plan(queries.supporters(spark, data)))) == 0


def test_compilers_meet_cells_without_other_fields(spark, data):
    records, cells = feeds.written(spark, data)
    events = queries._events(spark, records, "resolve_repeat_marker", ["note"]).drop("_k")
    made = plan(decisions.compile_repeat_marker(events, records, cells, "r", "2024-01-01"))
    assert "(field" in made and len(re.findall(r"Filter .*field#\d+ = note", made)) >= 2
    assert all("candidates" not in line for line in made.splitlines() if re.search(r"Join ", line))


def test_each(spark):
    for n in (1, 2, 4):
        df = spark.createDataFrame([(k, list(range(k)) if k < 6 else None) for k in range(7)], "k int, a array<int>")
        got = {r.k: r.b for r in df.select("k", text.each(F.col("a"), lambda x, i: x * 10 + i, n).alias("b")).collect()}
        assert got == {k: [x * 11 for x in range(k)] if k < 6 else None for k in range(7)}
    assert spark.range(1).select(text.tidy(F.lit("a b")), text.tidy(F.lit(" a")), text.tidy(F.lit("a  b")), text.tidy(F.lit("é"))).first()[:] == (True, False, False, False)


def test_shared_letters():
    """All pairs at once, against counting; rows of scores are those of all gains together."""
    import random
    from collections import Counter

    import numpy as np

    from tallyframe.operators.align import AlignmentConfig, SectionAligner, shared_letters

    rnd = random.Random(5)
    texts = ["".join(rnd.choice("aab é😀\ud800") for _ in range(rnd.randint(0, 9))) for _ in range(30)]
    rows, cols = np.arange(0, 30, 2), np.arange(1, 30, 3)
    want = [[sum((Counter(texts[i]) & Counter(texts[j])).values()) for j in cols] for i in rows]
    assert shared_letters(texts, rows, cols).tolist() == want
    assert shared_letters(["", ""], np.array([0]), np.array([1])).tolist() == [[0.0]]
    one, two = np.random.default_rng(1).uniform(-1, 1, (2, 5, 7))
    aligner = SectionAligner(AlignmentConfig())
    for gain, got in zip((one, two), aligner.scores(one, two)):
        table = aligner.config.gap_penalty * np.add.outer(np.arange(6), np.arange(8)).astype(float)
        for i in range(1, 6):
            for j in range(1, 8):
                table[i, j] = max(table[i - 1, j - 1] + gain[i - 1, j - 1], table[i - 1, j] - 0.4, table[i, j - 1] - 0.4)
        assert np.allclose(table, got)


def test_artifacts_are_parsed_once(spark, data, tmp_path):
    """The gate and what is read later look at lines that were parsed once, and equal provenances within a record once."""
    import json

    from tallyframe.sources import artifacts, jsonl
    from tallyframe.sources.work import new_path

    records, cells = feeds.written(spark, data)
    path = new_path(spark, "consensus")
    artifacts.consensus_lines(records, cells, list(feeds.ENGINES)).write.text(path)
    heads, again = artifacts.load_consensus(spark, path)
    assert "MapInArrow" not in heads._jdf.queryExecution().toString() + again._jdf.queryExecution().toString()
    one = json.loads(spark.read.text(path).first()[0])
    many = [c["provenance"] for cell in one["cells"].values() for c in cell["candidates"]]
    many[0]["source_row_index"], many[1]["source_row_index"] = 1, 1.0
    got = artifacts.parse_record(json.dumps(one))
    origins = [c["provenance"] for cell in got["cells"] for c in cell["candidates"]]
    assert origins == [artifacts._origin_json(p) for p in many]
    assert jsonl.load_json('{"a": [1, 1.0]}') == {"a": [1, 1.0]} and jsonl.canonical({"b": 1.0, "a": "é"}) == '{"a":"é","b":1.0}'
    for bad in ("NaN", "-Infinity", "﻿1", "1 2", ""):
        try:
            jsonl.load_json(bad)
            raise AssertionError(bad)
        except ValueError:
            pass


def test_views_stay_in_generated_code(spark):
    """Raw values by engine take no lambda for a few engines; a text without white space at its ends takes no expression."""
    from tallyframe.operators import enrich

    kind = "c array<struct<engine_id:string,raw:struct<t:string,s:string>>>"
    rows = [([(f"e{i}", ("str", 'a"') if i % 2 else None) for i in range(n)],) for n in (0, 1, 3, 6)]
    got = [r[0] for r in spark.createDataFrame(rows, kind).select(enrich.raw_by_engine_json(F.col("c"))).collect()]
    assert got == ["{" + ",".join(f'"e{i}":' + ('"a\\""' if i % 2 else "null") for i in range(n)) + "}" for n in (0, 1, 3, 6)]
    texts = spark.createDataFrame([(("str", s),) for s in (" a ", "a b", "", " ", "a\n", "a  b")] + [(("bool", "true"),), (None,)], "v struct<t:string,s:string>")
    assert [r[0] for r in texts.select(enrich.scalar_text(F.col("v"))).collect()] == ["a", "a b", None, None, "a", "a  b", "True", None]
    assert "slice(" in plan(spark.createDataFrame(rows, kind).select(enrich.raw_by_engine_json(F.col("c"))))


def test_folding_stays_out_of_lambdas(spark):
    """Compatibility folding calls Python; rules that begin with it, and with white space, give what Python gives."""
    from tallyframe.operators.normalize import Normalization, Rule

    import unicodedata

    samples = ["Ａ  b ", "a b", " é\t", "", None]
    df = spark.createDataFrame([({"x": ("str", s) if s is not None else None},) for s in samples], "cells map<string,struct<t:string,s:string>>")
    got = [r.v.s if r.v else None for r in normalized_rows(df, ["x"], Normalization(default=Rule())).select(F.col("norm")["x"]["value"].alias("v")).collect()]
    assert got == [" ".join(unicodedata.normalize("NFKC", s).split()) or None if s is not None else None for s in samples]
