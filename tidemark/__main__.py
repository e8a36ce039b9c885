"""python -m tidemark --data FOLDER --out FOLDER [QUERY ...]: run queries (default: all of the core) and write each as Parquet; --list names them, --csv writes CSV."""

from __future__ import annotations

import argparse
import json
import time

from tidemark.plans import registry
from tidemark.sources import sinks


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    p.add_argument("queries", nargs="*")
    p.add_argument("--data")
    p.add_argument("--out")
    p.add_argument("--shared", help="a folder that the driver and all executors share (spark.checkpoint.dir), needed on a cluster unless its settings name one")
    p.add_argument("--csv", action="store_true")
    p.add_argument("--list", action="store_true")
    a = p.parse_args(argv)
    known = registry.queries()
    if a.list:
        print("\n".join(known))
        return 0
    if not a.data or not a.out:
        p.error("--data and --out are needed")
    if unknown := [q for q in a.queries if q not in known]:
        p.error(f"unknown: {', '.join(unknown)}")
    from pyspark.sql import SparkSession

    builder = SparkSession.builder.config("spark.sql.session.timeZone", "UTC")
    spark = (builder.config("spark.checkpoint.dir", a.shared) if a.shared else builder).getOrCreate()
    for name in a.queries or known:
        start = time.time()
        out = known[name](spark, a.data)
        if a.csv:
            sinks.save_csv(out, f"{a.out}/{name}", one_file=True)
        else:
            out.write.mode("overwrite").parquet(f"{a.out}/{name}")
        print(json.dumps({"query": name, "seconds": round(time.time() - start, 2)}), flush=True)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
