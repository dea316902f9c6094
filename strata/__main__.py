"""Command line: ``python -m strata run|land|query``.

    run    --landing DIR --root DIR [--as-of DATE]   bronze → silver → gold
    land   --sf-dir DIR --landing DIR                deliver the derived feeds as files
    query  NAME --sf-dir DIR [--show N]              run one registered query

On a cluster the session comes from spark-submit (its settings, including
``spark.checkpoint.dir``, win); locally a session is built.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from .session import build_session
    return build_session("strata-cli")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="strata")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run")
    r.add_argument("--landing", required=True)
    r.add_argument("--root", required=True)
    r.add_argument("--as-of", default=None)
    la = sub.add_parser("land")
    la.add_argument("--sf-dir", required=True)
    la.add_argument("--landing", required=True)
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--sf-dir", required=True)
    q.add_argument("--show", type=int, default=20)
    args = ap.parse_args(argv)

    spark = _session()
    from .session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    if args.cmd == "run":
        from .plans import pipeline
        print(json.dumps(pipeline.run(spark, args.landing, args.root, as_of=args.as_of)))
    elif args.cmd == "land":
        from .plans import pipeline
        pipeline.land_feeds(spark, args.sf_dir, args.landing)
    else:
        from .catalog import load_all
        load_all()[args.name].build(spark, args.sf_dir).show(args.show, truncate=False)


if __name__ == "__main__":
    main()
