"""Command line: profile-validate, reconcile, review-export, review-apply, validate, publish, transcribe-parse, scan.

Exit codes: 0 done, 1 validation failed, cells unresolved or findings, 2 an error, 130 interrupted.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence
from pathlib import Path


def _session(args: argparse.Namespace):
    from pyspark.sql import SparkSession

    from .sources.work import ship

    builder = SparkSession.builder.appName("tallyframe").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false")
    if args.master:
        builder = builder.master(args.master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark


def _profile_validate(args: argparse.Namespace) -> tuple[dict, int]:
    from .sources.profile import load_profile

    profile = load_profile(args.profile)
    raw = profile.raw
    return {
        "valid": True, "profile": str(Path(args.profile).resolve()), "profile_id": raw.get("profile_id"), "profile_version": profile.version, "name": profile.name, "record_type": raw["record_type"],
        "field_count": len(profile.fields), "expected_sources": profile.section("consensus").get("expected_sources"), "parser": profile.section("parser").get("kind"),
    }, 0


def _reconcile(args: argparse.Namespace) -> tuple[dict, int]:
    from .plans import workflow

    return workflow.run_reconcile(_session(args), args.profile, args.input, args.output, args.parts), 0


def _review_export(args: argparse.Namespace) -> tuple[dict, int]:
    from .plans import workflow

    return workflow.export_review(_session(args), args.consensus, args.output, args.parts), 0


def _review_apply(args: argparse.Namespace) -> tuple[dict, int]:
    from .plans import workflow

    return workflow.apply_decision_file(_session(args), args.consensus, args.decisions, args.profile, args.output, args.default_reviewer, args.default_decided_at, args.parts), 0


def _validate(args: argparse.Namespace) -> tuple[dict, int]:
    from .plans import workflow

    report = workflow.validate(_session(args), args.consensus, args.profile, args.report)
    bad = not report["structurally_valid"] or (report["unresolved_cell_count"] and not args.allow_unresolved)
    return report, int(bool(bad))


def _publish(args: argparse.Namespace) -> tuple[dict, int]:
    from .plans import workflow

    return workflow.publish(_session(args), args.consensus, args.profile, args.output, args.allow_unresolved, args.research_formats, args.parts), 0


def _transcribe_parse(args: argparse.Namespace) -> tuple[dict, int]:
    """An answer that a transcriber has given, to rows of an engine. The answer comes from a file."""
    from .sources.jsonl import canonical
    from .sources.profile import load_profile
    from .sources.sinks import file_sha256, write_text
    from .sources.transcription import parse_response, prompt_fingerprint

    profile = load_profile(args.profile)
    text = Path(args.answer).read_text(encoding="utf-8")
    head = {"document_id": args.document_id, "page_id": args.page_id or f"page-{args.page_index}", "source_pdf_page_index": args.page_index, "engine_id": args.engine, "engine_version": args.engine_version}
    rows = [head | r | {"prompt_hash": prompt_fingerprint(profile)} for r in parse_response(text, profile)]
    out = write_text(args.output, [canonical(r) for r in rows])
    return {"engine_id": args.engine, "row_count": len(rows), "output": str(out.resolve()), "output_sha256": file_sha256(out)}, 0


def _scan(args: argparse.Namespace) -> tuple[dict, int]:
    from .functions.scan import scan_folder

    findings = scan_folder(args.root)
    return {"findings": findings}, int(bool(findings))


def build_parser() -> argparse.ArgumentParser:
    from . import VERSION

    parser = argparse.ArgumentParser(prog="tallyframe", description="Reconciles independent transcriptions of record tables.")
    parser.add_argument("--version", action="version", version=f"%(prog)s {VERSION}")
    parser.add_argument("--master", default="local[*]", help="Spark master; empty for that of the environment")
    parser.add_argument("--parts", action="store_true", help="leave tables as folders of parts")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, handler, text: str) -> argparse.ArgumentParser:
        own = commands.add_parser(name, help=text)
        own.set_defaults(handler=handler)
        return own

    command("profile-validate", _profile_validate, "check a profile").add_argument("profile")
    own = command("reconcile", _reconcile, "align and compare transcriptions")
    own.add_argument("--profile", required=True)
    own.add_argument("--input", required=True, action="append", help="JSON lines of an engine; repeat for each")
    own.add_argument("--output", required=True, help="folder of runs")
    own = command("review-export", _review_export, "write what is to be reviewed")
    own.add_argument("consensus")
    own.add_argument("--output", required=True)
    own = command("review-apply", _review_apply, "apply decisions or compile events")
    own.add_argument("consensus")
    own.add_argument("--decisions", required=True)
    own.add_argument("--profile", required=True)
    own.add_argument("--output")
    own.add_argument("--default-reviewer")
    own.add_argument("--default-decided-at")
    own = command("validate", _validate, "check structure, provenance and open cells")
    own.add_argument("consensus")
    own.add_argument("--profile", required=True)
    own.add_argument("--report")
    own.add_argument("--allow-unresolved", action="store_true")
    own = command("publish", _publish, "write research tables")
    own.add_argument("consensus")
    own.add_argument("--profile", required=True)
    own.add_argument("--output", required=True)
    own.add_argument("--allow-unresolved", action="store_true")
    own.add_argument("--research-formats", action="store_true")
    own = command("transcribe-parse", _transcribe_parse, "turn a transcriber's answer into rows")
    own.add_argument("answer")
    own.add_argument("--profile", required=True)
    own.add_argument("--engine", required=True)
    own.add_argument("--engine-version", required=True)
    own.add_argument("--document-id", required=True)
    own.add_argument("--page-index", required=True, type=int)
    own.add_argument("--page-id")
    own.add_argument("--output", required=True)
    command("scan", _scan, "look for secrets and private paths in a folder").add_argument("root", nargs="?", default=".")
    return parser


def main(argv: Sequence[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    try:
        result, code = args.handler(args)
    except KeyboardInterrupt:
        print("error: interrupted", file=sys.stderr)
        return 130
    except Exception as e:  # the command line reports, whatever it is
        print(f"error: {e}", file=sys.stderr)
        return 2
    print(json.dumps(result, ensure_ascii=False, sort_keys=True, indent=2, default=str))
    return code
