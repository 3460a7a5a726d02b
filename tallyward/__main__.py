"""python -m tallyward <incident folder> <dictionary folder>: load everything, print statistics."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tallyward.plans import warehouse
from tallyward.plans.adhoc import rows_as_dicts


def main() -> None:
    parser = argparse.ArgumentParser(prog="tallyward", description="Load the incident warehouse.")
    parser.add_argument("incidents", help="folder of incident files (*.csv)")
    parser.add_argument("dictionaries", help="folder of dictionary files")
    parser.add_argument("--on-violation", choices=["quarantine", "fail"], default="quarantine")
    options = parser.parse_args()
    spark = SparkSession.builder.appName("tallyward").getOrCreate()
    loads = warehouse.run(
        spark, options.incidents, options.dictionaries, on_violation=options.on_violation
    )
    for name, load in loads.items():
        for stats in rows_as_dicts(load.stats):
            print(name, *stats.values(), sep="\t")


if __name__ == "__main__":
    main()
