"""Run one registered query as a batch job and write its result.

    spark-submit -m strata <query> <input_dir> <output_path> [--format parquet]
    python -m strata --list

The transformation is the pure registered function; reading and writing
happen only here (the job shape of the reference's Spark jobs).
"""

from __future__ import annotations

import argparse
import sys

from strata.plans import catalog
from strata.session import get_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="strata")
    ap.add_argument("query", nargs="?")
    ap.add_argument("input_dir", nargs="?")
    ap.add_argument("output_path", nargs="?")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--master", default=None)
    ap.add_argument("--list", action="store_true")
    a = ap.parse_args(argv)
    if a.list or not a.query:
        print("\n".join(sorted(catalog.QUERIES)))
        return 0
    if a.query not in catalog.QUERIES or not (a.input_dir and a.output_path):
        ap.error("need a registered query, an input folder and an output path")
    spark = get_session(a.master, app=f"strata-{a.query}")
    df = catalog.QUERIES[a.query](spark, a.input_dir)
    df.write.mode("overwrite").format(a.format).save(a.output_path)
    return 0


if __name__ == "__main__":
    sys.exit(main())
