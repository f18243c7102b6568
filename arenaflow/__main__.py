"""Command line entry points (``spark-submit -m``-style or ``python -m arenaflow``).

    python -m arenaflow match-export     --participants G --matches G --admissions G --out ROOT  START END HERO ELO MODES SDK SCORE
    python -m arenaflow participant-export ... (same arguments)
    python -m arenaflow monthly-qa       ... (same arguments; prints month counts of both exports)
    python -m arenaflow land             --source GLOB --log participants|matches|admissions --target DIR
    python -m arenaflow framed           --path DIR --out DIR

Log arguments are JSON globs (``root/*/*/*/*``), with ``--landed`` folders
written by ``land``, or with ``--tables`` names of catalog tables.  The session comes from ``SparkSession.builder`` (cluster
settings apply); nothing is collected except the small QA tables.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from arenaflow.params import RunParams
from arenaflow.schemas import ADMISSIONS, MATCHES, PARTICIPANTS

SCHEMAS = {"participants": PARTICIPANTS, "matches": MATCHES, "admissions": ADMISSIONS}


def _logs(spark, args):
    from arenaflow.sources.logs import Logs, log_quality, read_json_log

    if args.tables:
        return Logs.from_tables(spark, *(getattr(args, n) for n in SCHEMAS))
    if args.landed:
        from arenaflow.streaming.landing import read_landed

        landed = (read_landed(spark, getattr(args, n), s, keep_partition=True) for n, s in SCHEMAS.items())
        return Logs(*landed, date_partitioned=True)
    if not args.no_report:
        for n, s in SCHEMAS.items():
            r = log_quality(read_json_log(spark, getattr(args, n), s)).first()
            print(f"{n}: {r['lines']} lines, {r['corrupt_lines']} not JSON, {r['uncast_values']} values not of their type")
    return Logs.from_json(spark, *(getattr(args, n) for n in SCHEMAS))


def _job_parser(sub, name, help_):
    p = sub.add_parser(name, help=help_)
    for n in SCHEMAS:
        p.add_argument(f"--{n}", required=True)
    p.add_argument("--landed", action="store_true", help="logs are landed Parquet folders")
    p.add_argument("--tables", action="store_true", help="logs are catalog tables, by name")
    p.add_argument("--no-report", action="store_true", help="skip the pass that counts unreadable lines and values")
    p.add_argument("--overwrite", action="store_true", help="replace an export that is there")
    p.add_argument("--publish", action="store_true", help="match-export: publish both exports together, readers follow a manifest")
    p.add_argument("--out", help="export root")
    p.add_argument("run", nargs=7, metavar="ARG", help="start end hero_id team_elo modetids sdk_version score")
    return p


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="arenaflow")
    sub = ap.add_subparsers(dest="cmd", required=True)
    _job_parser(sub, "match-export", "match records and participant detail")
    _job_parser(sub, "participant-export", "participant records")
    _job_parser(sub, "monthly-qa", "monthly counts of the match and detail records")
    land = sub.add_parser("land", help="land JSON logs as date-partitioned Parquet")
    land.add_argument("--source", required=True)
    land.add_argument("--log", required=True, choices=sorted(SCHEMAS))
    land.add_argument("--target", required=True)
    fr = sub.add_parser("framed", help="extract the last section of every framed gzip file")
    fr.add_argument("--path", required=True)
    fr.add_argument("--out", required=True)
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"arenaflow {args.cmd}").getOrCreate()
    from arenaflow.plans import jobs

    if args.cmd == "land":
        from arenaflow.streaming.landing import land_log

        land_log(spark, args.source, SCHEMAS[args.log], args.target).awaitTermination()
    elif args.cmd == "framed":
        from arenaflow.sources.framed import read_sections

        read_sections(spark, args.path).write.mode("overwrite").parquet(args.out)
    else:
        p = RunParams.from_argv(args.run)
        logs = _logs(spark, args)
        mode = "overwrite" if args.overwrite else "errorifexists"
        if args.cmd == "match-export" and args.publish:
            print(jobs.publish_match_exports(logs, p, args.out))
        elif args.cmd == "match-export":
            print(jobs.run_match_exports(logs, p, args.out, mode=mode))
        elif args.cmd == "participant-export":
            print(jobs.run_participant_export(logs, p, args.out, mode=mode))
        else:
            for name, df in (("matches", jobs.monthly_match_counts(logs, p)),
                             ("participants", jobs.monthly_participant_counts(logs, p)),
                             ("players", jobs.monthly_player_counts(logs, p))):
                for r in df.orderBy("pt_dt_date").collect():
                    print(name, r["pt_dt_date"], r["record_count"])
    return 0


if __name__ == "__main__":
    sys.exit(main())
