"""Run folders, artifacts, review, publication and the command line, on two engines' rows of two pages."""

import copy
import csv
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyframe import cli
from tallyframe.functions import scan, typed
from tallyframe.operators import decisions, review
from tallyframe.plans import reconcile as job
from tallyframe.plans import workflow
from tallyframe.sources import artifacts, jsonl, sinks, transcription
from tallyframe.sources.profile import ProfileError, load_profile, parse_profile

PROFILE = """
profile_version: "1"
name: cards
record_type: card
fields:
  - {name: item_name, semantic_role: label}
  - {name: code}
  - {name: place}
  - {name: day, semantic_role: date}
  - {name: quantity, semantic_role: quantity}
  - {name: amount, semantic_role: amount}
  - {name: amount_unit, semantic_role: amount_unit}
  - {name: note}
page_identity: {source_pdf_page_index: {required: true}}
quality: {require_complete_page_identity: true}
ocr:
  instructions: Keep ditto marks.
  engines:
    - {id: net, model: m-1, api_key_env: KEY, max_attempts: 2}
    - {id: other, type: local}
alignment: {anchor_engine: ocr-alpha, weights: {item_name: 0.4, code: 0.4, day: 0.2}}
comparison_normalization:
  default: {transforms: [nfkc, strip, collapse_whitespace]}
  fields: {code: {transforms: [strip, upper]}}
normalization:
  amounts:
    currency_aliases: {USD: [USD], EUR: [EUR], TOK: [TOK]}
    scale_factors: {thousand: "1,000", odd: many}
    denominator_label: items
"""
TIME = "2000-01-01T00:00:00Z"


def row(engine, page, index, pdf, name, code, place, day, quantity, amount, unit="", note=""):
    cells = dict(item_name=name, code=code, place=place, day=day, quantity=quantity, amount=amount, amount_unit=unit, note=note)
    section = {"document_id": "synthetic-archive-001", "page_id": f"synthetic-page-{page}", "table_id": f"synthetic-table-{page}"}
    return section | {"engine_id": engine, "engine_version": "1", "source_row_index": index, "source_pdf_page_index": pdf, "printed_page_label": page.upper(), "cells": cells, "bbox": [1, 2]}


ALPHA = [
    row("ocr-alpha", "a", 0, 0, "Blue Map", "M-1", "Hall", "2001-04", "3", "USD 125.50", "USD/item"), row("ocr-alpha", "a", 1, 0, "DITTO", "M-2", "DITTO", "2002", "4", "EUR 9 (reported equivalent TOK 1,117.25)"),
    row("ocr-alpha", "a", 2, 0, "Red Chart", "M-3", "Loft", "2003-11", "", "EUR 73.40 per item"), row("ocr-alpha", "b", 0, 1, "Green Plan", "P-1", "Yard", "2004-08", "1.5", "none"),
    row("ocr-alpha", "b", 1, 1, "Grey Sheet", "P-2", "Yard", "2004 to 2005", "6", "USD 540 (6 items total)"),
]
BETA = [
    row("ocr-beta", "a", 0, 0, "Blue  Map", "m-1", "Hall", "2001-04", "3", "USD 125.50", "USD/item"), row("ocr-beta", "a", 1, 0, "SAME", "M-2", "SAME", "2002", "4", "EUR 9 (reported equivalent TOK 1,117.25)"),
    row("ocr-beta", "a", 2, 0, "Rod Chart", "M-3", "Loft", "2003-11", "", "EUR 73.40 per item"), row("ocr-beta", "b", 1, 1, "Grey Sheet", "P-2", "Yard", "2004 to 2005", "6", "USD 540 (6 items total)"),
]


def target(page, index, **more):
    return {"document_id": "synthetic-archive-001", "page_id": f"synthetic-page-{page}", "table_id": f"synthetic-table-{page}", "source_row_index": index} | more


def events():
    seen = {"rationale": "seen", "reviewer_kind": "reader", "status": "approved"}
    repeat = lambda std: {"raw_by_engine": {"ocr-alpha": "DITTO", "ocr-beta": "SAME"}, "std": std}
    return copy.deepcopy([
        {"decision_id": "d-1", "decision_type": "choose_candidate", "target": target("a", 2, field_name="item_name"), "chosen": {"raw": "Red Chart", "std": "Red Chart", "engine_id": "ocr-alpha"},
         "evidence": {"candidate_values": ["Red Chart", "Rod Chart"], "engine_ids": ["ocr-alpha", "ocr-beta"]}} | seen,
        {"decision_id": "d-2", "decision_type": "accept_single_source_row", "target": target("b", 0), "chosen": {"engine_id": "ocr-alpha"}, "evidence": {"present_engines": ["ocr-alpha"], "missing_engines": ["ocr-beta"]}} | seen,
        {"decision_id": "d-3", "decision_type": "resolve_repeat_marker", "target": target("a", 1, field_names=["item_name", "place"]), "chosen": {"item_name": repeat("Blue Map"), "place": repeat("Hall")},
         "evidence": {"inherits_from_source_row_index": 0, "same_table_only": True}} | seen,
    ])


def lines(path, rows):
    path.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows), encoding="utf-8")
    return str(path)


def read(path):
    return [json.loads(x) for x in open(path, encoding="utf-8")]


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    (folder / "profile.yaml").write_text(PROFILE)
    return {"profile": str(folder / "profile.yaml"), "a": lines(folder / "a.jsonl", ALPHA), "b": lines(folder / "b.jsonl", BETA), "events": lines(folder / "events.jsonl", events()), "folder": folder}


@pytest.fixture(scope="module")
def run(spark, files):
    return workflow.run_reconcile(spark, files["profile"], [files["a"], files["b"]], str(files["folder"] / "runs"))


@pytest.fixture(scope="module")
def loaded(spark, run):
    records, cells = artifacts.load_consensus(spark, run["consensus"])
    return records.cache(), cells.cache()


def test_reconcile_review_publish(spark, files, run):
    folder = files["folder"]
    again = workflow.run_reconcile(spark, files["profile"], [files["a"], files["b"]], str(folder / "runs"))
    assert again["run_id"] == run["run_id"] and len(run["run_id"]) == 16
    assert (run["aligned_records"], run["unresolved_cells"], run["missing_source_rows"], run["rows_by_engine"]) == (5, 11, 1, {"ocr-alpha": 5, "ocr-beta": 4})
    found = read(run["consensus"])
    # golden ids, fixed values: they cover only keys of the rows
    assert [r["record_id"] for r in found] == [
        "rec_41b414677e5e682bdde1eaa4", "rec_ff8a8f9461dfcb22088fda15", "rec_683fd5e207df591cd8680d57", "rec_5099c89235b3229063146d88", "rec_cdfe22172b599b8b72fb3a33",
    ]
    assert found[0]["cells"]["item_name"]["cell_id"] == "cell_200c2fb8b8dceabbf9dd6dab"
    first = found[0]["cells"]["item_name"]["candidates"][1]
    origin = first["provenance"]
    assert origin["metadata"] == {"bbox": [1, 2], "input_artifact": "b.jsonl", "input_line_number": 1} and origin["source_ref"] == "b.jsonl:1"
    assert first["candidate_id"] == artifacts.stable_id("cand", found[0]["record_id"], "item_name", "item_name", "Blue  Map", origin)
    assert all(json.dumps(json.loads(x), sort_keys=True, ensure_ascii=False, separators=(",", ":")) == x.rstrip("\n") for x in open(run["consensus"], encoding="utf-8"))
    aligned = read(f"{run['run_directory']}/01-reconcile/aligned-rows.jsonl")
    assert [[r["engine_id"] for r in g["rows"]] for g in aligned] == [["ocr-alpha", "ocr-beta"]] * 3 + [["ocr-alpha"], ["ocr-alpha", "ocr-beta"]] and aligned[0]["rows"][1]["cells"] == BETA[0]["cells"]

    exported = workflow.export_review(spark, run["run_directory"], str(folder / "review"))
    queue, template = read(exported["review_queue"]), read(exported["decision_template"])
    assert exported["review_item_count"] == len(queue) == len(template) == 11
    assert [(q["ordinal"], q["cell"]["field"]) for q in queue[:3]] == [(2, "item_name"), (2, "place"), (3, "item_name")] and "chosen_value" in queue[0]["decision_contract"]["required"]
    assert {t["metadata"]["source_consensus_sha256"] for t in template} == {sinks.file_sha256(run["consensus"])}

    done = workflow.apply_decision_file(spark, run["consensus"], files["events"], files["profile"], None, None, TIME)
    assert (done["compiled_decision_count"], done["remaining_review_items"], done["ready_to_publish"]) == (11, 0, True) and "/02-review/apply_" in done["application_directory"]
    made = read(done["compiled_decisions"])
    assert Counter(d["metadata"]["source_decision_id"] for d in made) == {"d-1": 1, "d-2": 8, "d-3": 2}
    assert {d["reviewer"] for d in made} == {"reader"} and {d["decided_at"] for d in made} == {TIME} and len({d["decision_id"] for d in made}) == 11
    assert all(("candidate_id" in d) == (d["metadata"]["source_decision_type"] != "resolve_repeat_marker") for d in made)
    for d in made:
        assert d["decision_id"] == artifacts.stable_id("dec", d["cell_id"], d["chosen_value"], d.get("candidate_id"), d["reason"], d["reviewer"])
    # the compiled decisions are a decision file themselves, and say the same
    twice = workflow.apply_decision_file(spark, run["consensus"], done["compiled_decisions"], files["profile"], str(folder / "apps"))
    assert read(twice["reviewed_consensus"]) == read(done["reviewed_consensus"]) and twice["application_id"] == done["application_id"]
    assert read(done["reviewed_consensus"])[1]["cells"]["place"]["status"] == "conflict"

    with pytest.raises(job.PublicationError, match="11 unresolved"):
        workflow.publish(spark, run["consensus"], files["profile"], str(folder / "never"))
    out = folder / "publication"
    about = workflow.publish(spark, done["application_directory"], files["profile"], str(out), research_formats=True)
    quality = about["quality"]
    assert (quality["published_records"], quality["manual_or_agent_decisions"], quality["cell_decisions"], quality["price_observations"], quality["unresolved_price_observations"]) == (5, 3, 11, 6, 3)
    assert quality["currencies"] == ["EUR", "TOK", "USD"] and quality["provenance_completeness"] == 1.0 and quality["status_counts"] == {"conflict": 3, "missing": 8, "unanimous": 29}
    records, prices = read(out / "records.jsonl"), read(out / "prices.jsonl")
    assert [r["record_status"] for r in records] == ["unanimous", "resolved_by_decision", "resolved_by_decision", "resolved_by_decision", "unanimous"]
    assert records[0]["fields"]["quantity"]["std"] == 3 and records[3]["fields"]["quantity"]["std"] == 1.5 and records[2]["fields"]["quantity"]["std"] is None
    assert records[1]["fields"]["place"] == {"cell_id": records[1]["fields"]["place"]["cell_id"], "raw": {"ocr-alpha": "DITTO", "ocr-beta": "SAME"}, "status": "resolved_by_decision", "std": "Hall"}
    assert [len(r["decision_ids"]) for r in records] == [0, 2, 1, 8, 0] and records[4]["date"]["date_precision"] == "range_year"
    assert [p["price_id"] for p in prices if p["record_id"] == records[1]["record_id"]] == records[1]["fields"]["amount"]["std"] and len(records[1]["fields"]["amount"]["std"]) == 2
    assert prices[0]["source_cell_ids"] == [records[0]["fields"]["amount"]["cell_id"]] and (prices[0]["value_numeric"], prices[0]["scale_factor"], prices[0]["source_reported"]) == (125.5, 1, True)
    raw = (out / "records.csv").read_bytes()
    assert raw.startswith(b"\xef\xbb\xbfrecord_id,") and raw.count(b"\r\n") == 6
    table = list(csv.DictReader(open(out / "cells.csv", encoding="utf-8-sig", newline="")))
    assert len(table) == 40 and json.loads(table[0]["raw_by_engine_json"]) == {"ocr-alpha": "Blue Map", "ocr-beta": "Blue  Map"}
    assert [r["field"] for r in table[:8]] == list(load_profile(files["profile"]).fields)
    import duckdb

    with duckdb.connect(str(out / "research.duckdb"), read_only=True) as con:
        assert [con.execute(f"SELECT count(*) FROM {t}").fetchone()[0] for t in ("records", "cells", "prices")] == [5, 40, 6]


def test_rows_are_parsed_and_aligned_once(spark, files, monkeypatch):
    """However many checks, summaries and files there are."""
    calls = Counter()
    for module, name in ((job.align, "align_fuzzy"), (jsonl, "read_rows")):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, real=real, name=name, **k: (calls.update([name]), real(*a, **k))[1])
    found = job.reconcile_files(spark, [files["a"], files["b"]], load_profile(files["profile"]))
    for table in (found.records, found.cells, found.review_queue(), found.rows):
        plan = table._jdf.queryExecution().toString()
        assert "MapInArrow" not in plan and "FlatMapGroupsInPandas" not in plan  # read back, not made again
    found.close()
    assert calls == {"align_fuzzy": 1, "read_rows": 1}


def compiled(spark, loaded, rows, tmp_path, **more):
    path = lines(tmp_path / "e.jsonl", rows)
    return decisions.compile_events(artifacts.read_events(spark, path), *loaded, ["ocr-alpha", "ocr-beta"], decided_at=more.pop("decided_at", TIME), **more)


def changed(index, *path, value):
    made = events()[index]
    at = made
    for k in path[:-1]:
        at = at[k]
    at[path[-1]] = value
    return [made]


@pytest.mark.parametrize(
    ("rows", "what"),
    [
        (changed(0, "target", "source_row_index", value=99), "unknown_row"), (changed(0, "target", "source_row_index", value="2"), "unknown_row"), (changed(0, "target", "document_id", value=""), "document_id must be a text"),
        (changed(0, "target", "source_row_index", value=-1), "source_row_index must be"), (changed(0, "target", "field_name", value="nothing"), "unknown_field"), (changed(0, "target", "field_name", value="code"), "already_resolved"),
        (changed(0, "chosen", "raw", value="Absent"), "no_single_candidate"), (changed(0, "chosen", "std", value="red chart"), "value_mismatch"), (changed(0, "evidence", "candidate_values", value=["Red Chart"]), "values_mismatch"),
        (changed(0, "evidence", "engine_ids", value=["ocr-alpha"]), "engines_mismatch"), (changed(0, "evidence", "engine_ids", value=["a", "a"]), "must not repeat"), (changed(0, "status", value="pending"), "not_approved"),
        (changed(0, "decision_type", value="guess"), "unsupported_type"), (changed(0, "rationale", value=" "), "rationale must be"), (changed(0, "reviewer_kind", value=None), "reviewer_required"),
        (changed(1, "evidence", "missing_engines", value=["ocr-gamma"]), "missing_engines_mismatch"), (changed(1, "chosen", "engine_id", value="ocr-beta"), "not_single_source"), (changed(1, "target", "source_row_index", value=1), "not_single_source"),
        (changed(2, "chosen", "place", "raw_by_engine", value={"ocr-alpha": "DITTO", "ocr-beta": "STALE"}), "values_mismatch"), (changed(2, "chosen", "place", "raw_by_engine", value={"ocr-beta": "DITTO", "ocr-alpha": "SAME"}), "values_mismatch"),
        (changed(2, "chosen", "place", "std", value="Attic"), "value_mismatch"), (changed(2, "evidence", "inherits_from_source_row_index", value=2), "predecessor_not_earlier"), (changed(2, "evidence", "same_table_only", value=1), "same_table_only"),
        (changed(2, "target", "field_names", value=["place"]), "fields of target.field_names"), (changed(2, "evidence", "inherits_from_source_row_index", value=7), "unknown_or_ambiguous_row"),
        (events()[:1] + events()[:1], "duplicate_event"), (events()[:1] + [events()[0] | {"decision_id": "d-9"}], "duplicate_target"),
    ],
)
def test_events_that_do_not_fit(spark, loaded, tmp_path, rows, what):
    with pytest.raises(decisions.DecisionCompileError, match=what):
        compiled(spark, loaded, rows, tmp_path)


def test_events_need_a_time(spark, loaded, tmp_path):
    with pytest.raises(decisions.DecisionCompileError, match="decided_at_required"):
        compiled(spark, loaded, events(), tmp_path, decided_at=None)
    assert compiled(spark, loaded, events(), tmp_path).count() == 11


def test_replay(spark, loaded, tmp_path):
    _, cells = loaded
    one = cells.where("ordinal = 3 AND field = 'item_name'").first()
    base = {"cell_id": one.cell_id, "chosen_value": "Red Chart", "reason": "r", "reviewer": "x", "decided_at": "t"}
    names = {c.engine_id: c.candidate_id for c in one.candidates}

    def apply(*rows, strict=True):
        made = artifacts.read_decisions(spark, lines(tmp_path / "d.jsonl", rows))
        return review.apply_decisions(cells, made, strict).where(F.col("cell_id") == one.cell_id).first()

    got = apply(base)
    assert (got.chosen.s, got.supporting_candidate_ids, got.status) == ("Red Chart", [names["ocr-alpha"]], "conflict")
    assert apply(base | {"chosen_value": "Brown Chart"}).supporting_candidate_ids == []
    assert apply(base | {"chosen_value": "Rod Chart", "candidate_id": names["ocr-beta"]}).chosen.s == "Rod Chart"
    for wrong, what in (({"candidate_id": "cand_x"}, "foreign_candidate"), ({"candidate_id": names["ocr-beta"]}, "value_mismatch"), ({"cell_id": "cell_x"}, "unknown_cell")):
        with pytest.raises(review.DecisionApplyError, match=what):
            apply(base | wrong)
    with pytest.raises(review.DecisionApplyError, match="duplicate"):
        apply(base, base)
    assert apply(base, base | {"cell_id": "cell_x"}, strict=False).chosen.s == "Red Chart"
    with pytest.raises(jsonl.DataContractError, match="line 2: decision is missing required fields: reason"):
        artifacts.read_decisions(spark, lines(tmp_path / "bad.jsonl", [base, {k: v for k, v in base.items() if k != "reason"}]))


def test_decision_files(spark, loaded, tmp_path):
    canonical = {"cell_id": "c", "chosen_value": 1, "reason": "r", "reviewer": "x", "decided_at": "t"}
    assert artifacts.decision_file_kind(spark, lines(tmp_path / "c.jsonl", [canonical])) == "decisions"
    assert artifacts.decision_file_kind(spark, lines(tmp_path / "e.jsonl", events())) == "events"
    for name, rows in (("mixed", [canonical, events()[0]]), ("empty", [])):
        with pytest.raises(artifacts.ArtifactError, match="not both|empty"):
            artifacts.decision_file_kind(spark, lines(tmp_path / f"{name}.jsonl", rows))


def test_artifacts(spark, run, tmp_path):
    good = read(run["consensus"])
    records, cells = artifacts.load_consensus(spark, run["consensus"])
    assert [json.loads(r[0]) for r in artifacts.consensus_lines(records, cells, []).collect()] == good
    for change, what in (
        (lambda r: r.pop("sources"), "missing 'sources'"), (lambda r: r.update(sources=[]), "needs a source"), (lambda r: r.update(anchor_engine_id="nobody"), "none of the sources"),
        (lambda r: r["sources"].append(r["sources"][0]), "a row of each engine"), (lambda r: r["cells"]["code"].update(cell_id="cell_x"), "does not match"), (lambda r: r["cells"]["code"].update(status="fine"), "unknown status"),
    ):
        bad = copy.deepcopy(good)
        change(bad[1])
        with pytest.raises(jsonl.DataContractError, match=f"line 2: .*{what}"):
            artifacts.load_consensus(spark, lines(tmp_path / "bad.jsonl", bad))
    wrong = copy.deepcopy(good)
    wrong[0]["cells"]["code"]["candidates"][0]["provenance"]["page_id"] = "elsewhere"
    wrong[0]["cells"]["code"]["candidates"][1]["field"] = "note"
    wrong[1]["sources"][1]["table_id"] = "elsewhere"
    wrong[2]["sources"][0]["source_pdf_page_index"] = None
    (tmp_path / "profile.yaml").write_text(PROFILE)
    report = workflow.validate(spark, lines(tmp_path / "wrong.jsonl", wrong), str(tmp_path / "profile.yaml"))
    said = "\n".join(report["errors"])
    assert all(x in said for x in ("has wrong section", "has wrong field", "source section does not match", "lacks source_pdf_page_index", "record_id does not match anchor provenance"))
    assert not report["structurally_valid"] and report["error_count"] == len(report["errors"]) == 5 and report["unresolved_cell_count"] == 11 == len(report["unresolved_targets"])
    (tmp_path / "two").mkdir()
    lines(tmp_path / "two/consensus.jsonl", good)
    assert artifacts.resolve_consensus(tmp_path / "two").name == "consensus.jsonl"
    lines(tmp_path / "two/reviewed-consensus.jsonl", good)
    with pytest.raises(artifacts.ArtifactError, match="exactly one"):
        artifacts.resolve_consensus(tmp_path / "two")
    with pytest.raises(artifacts.ArtifactError, match="does not exist"):
        artifacts.resolve_consensus(tmp_path / "nowhere")


def test_command_line(spark, files, run, capsys, monkeypatch):
    monkeypatch.setattr(cli, "_session", lambda args: spark)
    out = files["folder"] / "cli"

    def call(*argv):
        code = cli.main([str(a) for a in argv])
        text = capsys.readouterr()
        return code, json.loads(text.out) if text.out.strip().startswith("{") else text.err

    code, said = call("profile-validate", files["profile"])
    assert code == 0 and said["field_count"] == 8 and said["valid"]
    code, said = call("reconcile", "--profile", files["profile"], "--input", files["a"], "--input", files["b"], "--output", out / "runs")
    assert code == 0 and said["run_id"] == run["run_id"]
    folder = said["run_directory"]
    assert call("validate", folder, "--profile", files["profile"])[0] == 1
    assert call("validate", folder, "--profile", files["profile"], "--allow-unresolved", "--report", out / "report.json")[0] == 0 and (out / "report.json").is_file()
    code, said = call("publish", folder, "--profile", files["profile"], "--output", out / "p")
    assert code == 2 and "unresolved" in said
    assert call("review-export", folder, "--output", out / "review")[1]["review_item_count"] == 11
    code, said = call("review-apply", folder, "--decisions", files["events"], "--profile", files["profile"])
    assert code == 2 and "decided_at_required" in said
    code, said = call("review-apply", folder, "--decisions", files["events"], "--profile", files["profile"], "--default-decided-at", TIME)
    assert code == 0 and call("validate", said["application_directory"], "--profile", files["profile"])[0] == 0
    code, said = call("--parts", "publish", said["application_directory"], "--profile", files["profile"], "--output", out / "parts")
    assert code == 0 and spark.read.text(str(out / "parts/records.jsonl")).count() == 5 and spark.read.option("header", True).csv(str(out / "parts/cells.csv")).count() == 40
    assert call("reconcile", "--profile", files["profile"], "--input", files["a"], "--output", out / "runs")[0] == 2


def test_json_forms(spark, tmp_path):
    """Any column as Python's json writes it; NaN is refused."""
    import datetime

    numbers = [0.0, -0.0, 1.0, -2.5, 1e7, 12345678.9, 1e15, 1.5e16, 1e16, 1e22, 123456789012345680.0, 1e-3, 1.25e-4, 1e-4, 9.5e-5, -3e-7, 1 / 3, 1e300]
    got = spark.createDataFrame([(x,) for x in numbers], "x double").select("x", typed.double_text(F.col("x")).alias("t")).collect()
    assert [r.t for r in got] == [json.dumps(x) for x in numbers]
    odd = [2.0**60, 5e-324, 2.0**-1074 * 3]  # the JVM may write more digits than are needed
    assert [float(r.t) for r in spark.createDataFrame([(x,) for x in odd], "x double").select(typed.double_text(F.col("x")).alias("t")).collect()] == odd
    row_ = (datetime.date(2024, 1, 2), 1e7, {"b": 1, "a": None}, [1.5, None], ("x", None), True, 'q"\n', {"t": "float", "s": "1e+16"}, None)
    df = spark.createDataFrame([row_], "d date, x double, m map<string,int>, l array<double>, st struct<b:string,a:int>, o boolean, `k\"y` string, v struct<t:string,s:string>, n string")
    assert sinks.json_lines(df).first()[0] == '{"d":"2024-01-02","k\\"y":"q\\"\\n","l":[1.5,null],"m":{"a":null,"b":1},"n":null,"o":true,"st":{"a":null,"b":"x"},"v":1e+16,"x":10000000.0}'
    with pytest.raises(Exception, match="NaN and infinity are not JSON"):
        sinks.json_lines(spark.createDataFrame([(float("nan"),)], "x double")).collect()
    sinks.write_document({"b": 1, "a": "é"}, tmp_path / "x/d.json")
    assert (tmp_path / "x/d.json").read_text(encoding="utf-8") == '{\n  "a": "é",\n  "b": 1\n}\n' and len(list((tmp_path / "x").iterdir())) == 1
    with pytest.raises(ValueError):
        sinks.write_document({"x": float("nan")}, tmp_path / "x/e.json")
    assert not (tmp_path / "x/e.json").exists()


def test_lines(spark, tmp_path):
    """Blank lines of any white space are none; only the first line loses a byte-order mark; numbers go on across parts."""
    path = tmp_path / "l.jsonl"
    many = [json.dumps({"n": k}) for k in range(3000)]
    path.write_text("﻿a\n\t\n 　 \n﻿b\n" + "\n\n".join(many) + "\n", encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = jsonl.read_lines(spark, [str(path), str(path)]).orderBy("file_ord", "line_no").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = ["a", "﻿b", *many]
    assert [(r.file_ord, r.line_no, r.line) for r in got] == [(f, n, x) for f in (0, 1) for n, x in enumerate(want, 1)]
    (tmp_path / "c.csv").write_text("﻿x,y\n1,é\n", encoding="utf-8")
    assert [tuple(r) for r in jsonl.read_csv(spark, str(tmp_path / "c.csv")).collect()] == [("1", "é")]


def test_manifest(tmp_path):
    a, b, p = tmp_path / "a", tmp_path / "b", tmp_path / "p"
    for f, text in ((a, "1"), (b, "2"), (p, "3")):
        f.write_text(text)
    first = sinks.manifest(p, [a, b], "1", {"x": 1}, tmp_path)
    assert first["run_id"] == sinks.manifest(p, [b, a], "1", {"x": 1}, tmp_path)["run_id"] and [i["path"] for i in first["inputs"]] == ["a", "b"]
    ids = {first["run_id"], sinks.manifest(p, [a], "1", {"x": 1})["run_id"], sinks.manifest(p, [a, b], "1", {"x": 2})["run_id"]}
    a.rename(tmp_path / "c")
    assert len(ids | {sinks.manifest(p, [tmp_path / "c", b], "1", {"x": 1})["run_id"]}) == 4


def test_transcription(files):
    profile = load_profile(files["profile"])
    config = transcription.provider_config(profile, "net")
    assert (config.model, config.max_attempts, config.timeout_seconds) == ("m-1", 2, 120.0)
    for name in ("other", "nobody"):
        with pytest.raises(ProfileError):
            transcription.provider_config(profile, name)
    prompt = transcription.system_prompt(profile)
    assert '"name": "item_name"' in prompt and "Keep ditto marks." in prompt and len(transcription.prompt_fingerprint(profile)) == 64 != transcription.prompt_sha256(prompt)
    rows = transcription.parse_response('```json\n{"rows": [{"cells": {"code": "017"}}, {"source_row_index": 5, "table_id": "t", "cells": {}}]}\n```', profile)
    assert [(r["source_row_index"], r["table_id"]) for r in rows] == [(0, "main"), (5, "t")] and rows[0]["cells"] == dict.fromkeys(profile.fields) | {"code": "017"}
    for bad in ("no", "[]", '{"rows": [1]}', '{"rows": [{"cells": {"other": 1}}]}'):
        with pytest.raises(transcription.TranscriptionError):
            transcription.parse_response(bad, profile)
    assert transcription.message_text([{"text": "a"}, {"type": "image"}, {"text": "b"}]) == "a\nb" and transcription.message_text("x") == "x"
    with pytest.raises(transcription.TranscriptionError):
        transcription.message_text([{"image": 1}])


def test_profile_rules():
    base = {"profile_version": "1", "name": "n", "record_type": "r", "fields": [{"name": "a"}]}
    profile = parse_profile(base | {"comparison_normalization": {"default": {"missing_values": [-999, "n/a", None, True]}}})
    assert profile.normalization().default.missing == (-999, "n/a", None, True)
    with pytest.raises(ProfileError, match="several fields"):
        parse_profile(base | {"fields": [{"name": "a", "semantic_role": "date"}, {"name": "b", "semantic_role": "date"}]})


def test_typed_sentinels(spark):
    from tallyframe.operators.normalize import Rule

    values = ["n/a", "-999", -999, -999.0, 0, False, 1, True, "", None]
    df = spark.createDataFrame([(k, jsonl.scalar(v)) for k, v in enumerate(values)], "k int, v struct<t:string,s:string>")
    for missing in ((-999, "n/a"), (0,), (True,), ("", None), ()):
        got = {r.k: r.v for r in df.select("k", Rule(transforms=(), missing=missing).apply(F.col("v")).alias("v")).collect()}
        assert [got[k] is None for k in range(len(values))] == [v is None or v in missing for v in values]


def test_folder_scan(tmp_path):
    for name, text in (("a.py", "x = 1"), ("b.txt", "token = 'abcdefghijklmnopqrstuvwxyz'"), (".env", ""), (".env.example", "secret=abcdefghijklmnopqrstuvwxyz"), ("c.PDF", "x"), ("examples/synthetic/d.png", "x"), (".git/e.pdf", "x")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    assert scan.scan_folder(str(tmp_path)) == ["credential file is not publishable: .env", "possible generic API key: b.txt", "unreviewed binary/source artifact: c.PDF"]


def test_three_engines_by_brute_force():
    """The dynamic programme over three engines, every similarity in full, against the one that leaves most of them out."""
    import random

    from tallyframe.operators.align import AlignmentConfig, SectionAligner

    class Plain(SectionAligner):
        def merge(self, groups, rows, cells):
            gap, n, m = self.config.gap_penalty, len(groups), len(rows)
            best = {(0, 0): (0.0, [])}
            for i in range(n + 1):
                for j in range(m + 1):
                    ways = []
                    if i and j:
                        s, out = best[i - 1, j - 1]
                        ways.append((s + self.increment([cells(x) for x in groups[i - 1]], cells(rows[j - 1])), [*out, [*groups[i - 1], rows[j - 1]]]))
                    if i:
                        s, out = best[i - 1, j]
                        ways.append((s + gap, [*out, groups[i - 1]]))
                    if j:
                        s, out = best[i, j - 1]
                        ways.append((s + gap, [*out, [rows[j - 1]]]))
                    if ways:
                        best[i, j] = max(ways, key=lambda w: w[0])  # the first of equals: pair, group, row
            return best[n, m][1]

    rnd = random.Random(3)
    text = lambda letters, most: ("str", "".join(rnd.choice(letters) for _ in range(rnd.randint(0, most))))
    for _ in range(60):
        engines = {e: [(e, k, {"n": text("abc ", 6) if rnd.random() < 0.9 else None, "q": ("int", str(rnd.randint(0, 2))), "z": text("ab", 3)}) for k in range(rnd.randint(1, 8))] for e in "abc"}
        config = AlignmentConfig(weights=rnd.choice([{}, {"n": 0.5, "q": 0.3, "z": 0.2}]), fuzzy_strings=rnd.random() < 0.8, anchor_engine=rnd.choice([None, "b"]))
        assert SectionAligner(config).align(engines, lambda r: r[2]) == Plain(config).align(engines, lambda r: r[2])


def test_natural_order_of_long_numbers(spark):
    from tallyframe.functions.text import natural_key

    names = ["p" + "9" * 45, "p0" + "9" * 44, "p10", "p2", "p002x"]
    got = [r.s for r in spark.createDataFrame([(n,) for n in names], "s string").orderBy(natural_key(F.col("s"))).collect()]
    assert got == ["p2", "p002x", "p10", "p0" + "9" * 44, "p" + "9" * 45]


def test_streamed_sections(spark, files, tmp_path):
    from tallyframe.streaming.sections import reconcile_stream

    profile = load_profile(files["profile"])
    rows = jsonl.read_rows(spark, [files["a"], files["b"]])
    for k, page in enumerate(("synthetic-page-a", "synthetic-page-b")):
        rows.where(F.col("page_id") == page).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    source = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    seen = []
    stream = reconcile_stream(source, profile, ["ocr-alpha", "ocr-beta"], str(tmp_path / "out"), str(tmp_path / "check"), lambda cells, n: seen.append((n, cells.count())))
    stream.processAllAvailable()
    stream.stop()
    assert sorted(n for _, n in seen) == [16, 24]
    whole = job.reconcile(rows, profile)
    mine = {(r.cell_id, r.status) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert mine == {(r.cell_id, r.status) for r in whole.cells.collect()}
    whole.close()
