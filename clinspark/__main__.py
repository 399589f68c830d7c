"""Command line: ``python -m clinspark run --sf-dir DIR --out-dir DIR [--mode full]``.

Runs one batch (P5) and prints the run summary as JSON. ``--profile cluster``
applies ``session.CLUSTER_CONF`` to settings the cluster has not set
explicitly.
"""
from __future__ import annotations

import argparse
import json
import sys

from .plans.batch import RunConfig, run
from .session import get_session


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="clinspark")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="one batch run: silver, quality gate, gold, models, run log")
    given = r.add_mutually_exclusive_group(required=True)
    given.add_argument("--sf-dir", help="folder with the input parquet tables")
    given.add_argument("--sources", help="JSON file: source name -> its format, path or table, and schema")
    r.add_argument("--out-dir", required=True, help="shared output folder (layers, reports, run log)")
    r.add_argument("--mode", default="full", choices=["full", "validate-only", "skip-validate"])
    r.add_argument("--threshold", type=float, default=None, help="quality gate threshold (default 0.95)")
    r.add_argument("--run-id", default=None)
    r.add_argument("--resume", action="store_true", help="go on with the run of that id: steps done with unchanged inputs are kept")
    r.add_argument("--database", default=None, help="catalog database that gets the tables of a successful run")
    r.add_argument("--profile", default="local", choices=["local", "cluster"])
    args = p.parse_args(argv)
    if args.resume and not args.run_id:
        p.error("--resume needs --run-id")

    spark = get_session(app="clinspark-run", profile=args.profile)
    cfg = RunConfig(args.sf_dir, args.out_dir, mode=args.mode, resume=args.resume, database=args.database)
    if args.sources:
        with open(args.sources) as f:
            cfg.sources = json.load(f)
    if args.threshold is not None:
        cfg.threshold = args.threshold
    if args.run_id:
        cfg.run_id = args.run_id
    res = run(spark, cfg)
    print(json.dumps({"run_id": res.run_id, "status": res.status, "overall_quality_score": res.overall_score,
                      "gate_passed": res.gate_passed, "duration_minutes": res.duration_minutes,
                      "records": res.records, "loaded": res.loaded, "phase_seconds": res.phases}))
    return 0 if res.status in ("SUCCESS", "VALIDATED") else 1


if __name__ == "__main__":
    sys.exit(main())
