"""Command line for the two jobs (``spark-submit rewardflow/cli.py ...``).

    spend --input <csv> --tenant <t> --dims <dir> --out <dir> --run-id <id> [--rates <json>]
    users --input <csv> --tenant <t> --targets <dir> --out <dir> [--reward-types <json>]
          [--order <column> ...] [--keep first|last]

``--dims`` holds parquet tables ``card_type``, ``mcc_exclusion``,
``campaign`` and ``custom_category``; ``--targets`` holds ``card_customer``,
``card``, ``card_type`` and ``campaign_customer``. The session comes from
spark-submit; only a local session without ``spark.checkpoint.dir`` gets a
scratch checkpoint folder. ``--rates`` maps currencies to conversion rates and
``--reward-types`` card types to reward types; ``--order created_at --keep last``
lets the latest user row win.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DIM_TABLES = {"card_types": "card_type", "exclusions": "mcc_exclusion", "rules": "campaign",
              "categories": "custom_category"}
TARGET_TABLES = {"card_customers": "card_customer", "cards": "card", "card_types": "card_type",
                 "campaign_customers": "campaign_customer"}


def main(argv: list[str] | None = None) -> dict:
    from pyspark.sql import SparkSession

    from rewardflow.plans.spend import run_spend_file
    from rewardflow.plans.users import write_users_run
    from rewardflow.schemas import USER_SCHEMA
    from rewardflow.session import checkpoint_dir
    from rewardflow.sources.files import read_csv

    ap = argparse.ArgumentParser(prog="rewardflow")
    sub = ap.add_subparsers(dest="job", required=True)
    sp = sub.add_parser("spend")
    sp.add_argument("--input", required=True)
    sp.add_argument("--tenant", required=True)
    sp.add_argument("--dims", required=True)
    sp.add_argument("--out", required=True)
    sp.add_argument("--run-id", required=True)
    sp.add_argument("--rates", type=json.loads)
    up = sub.add_parser("users")
    up.add_argument("--input", required=True)
    up.add_argument("--tenant", required=True)
    up.add_argument("--targets", required=True)
    up.add_argument("--out", required=True)
    up.add_argument("--reward-types", type=json.loads)
    up.add_argument("--order", nargs="*", default=())
    up.add_argument("--keep", choices=("first", "last"), default="first")
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"rewardflow-{a.job}").getOrCreate()
    checkpoint_dir(spark)
    if a.job == "spend":
        dims = {k: spark.read.parquet(f"{a.dims.rstrip('/')}/{v}") for k, v in DIM_TABLES.items()}
        rep = run_spend_file(spark, a.input, dims, a.tenant, a.out, a.run_id, rates=a.rates).first().asDict()
        print(json.dumps(rep))
        return rep
    targets = {k: spark.read.parquet(f"{a.targets.rstrip('/')}/{v}") for k, v in TARGET_TABLES.items()}
    users = read_csv(spark, a.input, USER_SCHEMA, spread_input=True)
    paths = write_users_run(spark, users, a.tenant, targets, a.out, a.reward_types, a.order, a.keep)
    print(json.dumps(paths))
    return paths


if __name__ == "__main__":
    main()
