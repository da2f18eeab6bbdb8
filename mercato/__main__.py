"""Command line: ``python -m mercato run|microbatch --out DIR (--csv DIR | --fixtures SF_DIR)``.

``run`` builds the warehouse (load, staging, dimensions, facts, quality gate,
summaries) and publishes it as a new version once its keys hold; ``microbatch`` builds the five-minute batch KPIs and roll-ups from
the stream tables. Prints the per-table timings and row counts as JSON.
"""

from __future__ import annotations

import argparse
import json
import sys

from .plans.pipeline import publish_pipeline, run_microbatch
from .session import get_session
from .sources.fixtures import Fixtures
from .sources.readers import read_dir


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="mercato")
    ap.add_argument("command", choices=["run", "microbatch"])
    ap.add_argument("--out", required=True, help="output root (a shared store on a cluster)")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv", help="directory of raw CSV exports (<table>.csv)")
    src.add_argument("--fixtures", help="directory of the driver parquet tables")
    ap.add_argument("--master", default=None)
    ap.add_argument("--parallel", type=int, default=4, help="concurrent table writes per layer")
    ap.add_argument("--keep", type=int, default=3, help="published versions that stay readable")
    ap.add_argument("--orphans", choices=["fail", "report"], default="fail", help="what foreign keys without a dimension row do")
    a = ap.parse_args(argv)
    spark = get_session(a.master)
    raw = Fixtures(spark, a.fixtures) if a.fixtures else read_dir(spark, a.csv)
    if a.command == "run":
        version, log = publish_pipeline(spark, raw, a.out, keep=a.keep, orphans=a.orphans, parallel=a.parallel)
        log.rows["version"] = version.number
    else:
        if a.csv:
            ap.error("microbatch needs the stream tables: use --fixtures")
        log = run_microbatch(spark, raw, a.out)
    print(json.dumps({"seconds": log.seconds, "rows": log.rows}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
