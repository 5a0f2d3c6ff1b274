"""Command line: ``python -m credlake <command> ...``.

    list                                  registered queries (and whether they have an oracle)
    run NAME --sf DIR [--out PATH] [--show N]
                                          run a registered query; write Parquet or print rows
    silver CSV GOLD_DIR MODEL_PATH        L1: fit, sign, bucket report, gold table, model file
    evaluate APPS_PARQUET MODEL GOLD OUT  part B: score applications against the gold history
    requests IN_DIR OUT_DIR [--flow NAME | --code CODE] [--errors DIR]
                                          L4: decide every request file with a flow

The session comes from ``SparkSession.builder`` (master and settings from
``spark-submit``); run with plain ``python`` it is a local session.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    """The submitted session (``spark-submit`` master and settings), else a
    local one; the checkpoint folder is only set when the cluster gave none."""
    from credlake.session import ensure_checkpoint_dir
    spark = SparkSession.getActiveSession() or (
        SparkSession.builder.appName("credlake").config("spark.ui.enabled", "false").getOrCreate())
    ensure_checkpoint_dir(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="credlake")
    sub = p.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    r = sub.add_parser("run")
    r.add_argument("name")
    r.add_argument("--sf", required=True)
    r.add_argument("--out")
    r.add_argument("--show", type=int, default=20)
    s = sub.add_parser("silver")
    s.add_argument("csv")
    s.add_argument("gold")
    s.add_argument("model")
    e = sub.add_parser("evaluate")
    e.add_argument("apps")
    e.add_argument("model")
    e.add_argument("gold")
    e.add_argument("out")
    q = sub.add_parser("requests")
    q.add_argument("indir")
    q.add_argument("outdir")
    q.add_argument("--flow", default="p0")
    q.add_argument("--code")
    q.add_argument("--errors", help="folder for unreadable request files")
    a = p.parse_args(argv)

    from credlake.plans import ORACLES, QUERIES
    if a.cmd == "list":
        for name in QUERIES:
            print(f"{name}\t{'sql' if name in ORACLES else 'rows'}")
        return 0
    spark = _session()
    from credlake.plans import jobs
    if a.cmd == "run":
        df = QUERIES[a.name](spark, a.sf)
        if a.out:
            df.write.mode("overwrite").parquet(a.out)
        else:
            df.show(a.show, truncate=False)
    elif a.cmd == "silver":
        print(json.dumps(jobs.silver_job(spark, a.csv, a.gold, a.model), default=str))
    elif a.cmd == "evaluate":
        print(jobs.lsh_evaluation_job(spark, spark.read.parquet(a.apps), a.model, a.gold, a.out))
    elif a.cmd == "requests":
        jobs.request_batch_job(spark, a.indir, a.outdir, a.flow, a.code, a.errors).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
