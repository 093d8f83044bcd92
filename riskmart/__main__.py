"""``python -m riskmart SOURCE ROOT``: land, conform, score; print counts and the scorecard.

Also a spark-submit entry point: the session takes its settings from the cluster.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from riskmart.model import SCORECARD_TABLE
from riskmart.plans import reports
from riskmart.plans.refresh import refresh
from riskmart.sources.files import LAYOUTS
from riskmart.sources.landing import IDENTITIES
from riskmart.sources.tables import read_table


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="riskmart", description=__doc__)
    parser.add_argument("source", help="folder of delivered CSV files")
    parser.add_argument("root", help="folder of the layers: bronze, silver, gold")
    parser.add_argument("--layout", choices=LAYOUTS, default="flat")
    parser.add_argument("--identity", choices=tuple(IDENTITIES), default="name")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("riskmart").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    counts = refresh(spark, args.source, args.root, layout=args.layout, identity=args.identity)
    for layer, tables in counts.items():
        print(f"{layer}: " + ", ".join(f"{name}={n}" for name, n in tables.items()))
    if counts["gold"][SCORECARD_TABLE] == 0:
        print("no scorecard rows")
    else:
        card = read_table(spark, f"{args.root.rstrip('/')}/gold", SCORECARD_TABLE)
        latest = reports.latest_snapshot(card)
        reports.without_rules(latest).show(latest.count(), truncate=False)  # a row per rule
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
