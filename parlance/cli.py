"""Command line: plan of chats, anonymize a raw store, verify a dataset.

Exit codes: 0 done, 1 wrong settings or arguments, 3 the self-check found a
leak, 4 the audit found one.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from .operators import audit, chats
from .plans import anonymize as plan_
from .plans import policy as policies
from .sources import schemas, store


def _raw(spark: SparkSession, folder: str) -> plan_.Raw:
    name = f"{folder}/state.json"
    state = json.loads(spark.read.text(name, wholetext=True).first()[0]) if store.exists(spark, name) else {}
    return plan_.Raw(store.read_messages(spark, f"{folder}/messages"), store.read_objects(spark, f"{folder}/users.json", schemas.USER), store.read_objects(spark, f"{folder}/chats.json", schemas.CHAT), state.get("me_id"))


def _persist(spark: SparkSession, folder: str):
    def run(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    return run


def cmd_chats(spark: SparkSession, args: argparse.Namespace, policy: policies.Policy) -> int:
    for r in chats.ordered(chats.plan(_raw(spark, args.raw).chats, policy.chats)).limit(1000).collect():
        print(f"{'+' if r['included'] else '-'} {r['id']} {r['kind']} {r['reason']}")
    return 0


def cmd_anonymize(spark: SparkSession, args: argparse.Namespace, policy: policies.Policy) -> int:
    old = f"{args.work}/mapping_kept"
    mapping = spark.read.parquet(old) if store.exists(spark, old) else spark.createDataFrame([], "kind string, raw_id bigint, vid string")
    made = plan_.anonymize(_raw(spark, args.raw), policy, mapping, _persist(spark, args.work))
    try:
        plan_.checked(made)
    except audit.LeakError as e:
        print(f"not written: {e}", file=sys.stderr)
        return 3
    store.write_dataset({"messages": made.messages, "episodes": made.episodes, "users": made.users, "chats": made.chats}, made.transcripts, made.chunks(), made.manifest(), args.out)
    made.mapping.write.mode("overwrite").parquet(f"{old}.new")
    store.swap(spark, f"{old}.new", old)
    store.write_private_json(f"{args.work}/manifest.json", made.manifest(), spark)
    store.write_private_json(f"{args.work}/report.json", made.report(), spark)
    store.make_private(spark, args.work)
    return 0


def cmd_verify(spark: SparkSession, args: argparse.Namespace, policy: policies.Policy) -> int:
    raw = _raw(spark, args.raw)
    mapping = spark.read.parquet(f"{args.work}/mapping_kept")
    if raw.messages.isEmpty():
        print("nothing is known without raw messages", file=sys.stderr)
        return 2
    exported = raw.chats.join(raw.messages.selectExpr("chat_id as id").distinct(), "id", "left_semi")
    roster = plan_.build_roster(raw, mapping, policy, exported)
    leaks = audit.scan_units(audit.file_units(spark, args.out, store.README), policy.anonymize, roster)
    counts, rows = audit.leak_report(leaks)
    by_kind = {r["kind"]: r["n"] for r in counts.collect()}
    store.write_private_json(f"{args.work}/leaks.json", {"by_kind": by_kind, "rows": [r.asDict() for r in rows.collect()]}, spark)
    print(json.dumps(by_kind, sort_keys=True))
    return 4 if by_kind else 0


def cmd_run(spark: SparkSession, args: argparse.Namespace, policy: policies.Policy) -> int:
    return cmd_anonymize(spark, args, policy) or cmd_verify(spark, args, policy)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="parlance", description=__doc__)
    commands = {"chats": cmd_chats, "anonymize": cmd_anonymize, "verify": cmd_verify, "run": cmd_run}
    parser.add_argument("command", choices=commands)
    parser.add_argument("--raw", required=True, help="folder of the raw store")
    parser.add_argument("--work", default="work", help="private folder: mapping, reports, intermediate tables")
    parser.add_argument("--out", default="dataset", help="folder of the shareable dataset")
    parser.add_argument("--config", help="TOML file of settings")
    args = parser.parse_args(argv)
    try:
        policy = policies.load(args.config) if args.config else policies.Policy()
    except (policies.PolicyError, OSError) as e:
        print(e, file=sys.stderr)
        return 1
    spark = spark or SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    return commands[args.command](spark, args, policy)


if __name__ == "__main__":
    sys.exit(main())
