"""python -m clearwell COMMAND

build-lookup DIRECTORY GEOCODES OUT   the reference dimension as one CSV file
run DOCUMENTS PAGES ANSWERS OUT       an ingest run over Parquet tables; its tables go below OUT
export FACTS LOOKUP OUT               facts (Parquet) with what the lookup (CSV) has for their schools, and the unmatched schools
summary OUT                           rows of a run's tables, and its issues by type
query NAME SF_DIR                     a registered query
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession


#: The tables of a run.
TABLES = ("accepted", "issues", "schools", "documents", "counters")


def main(args: list[str]) -> int:
    spark = SparkSession.builder.appName("clearwell").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    match args:
        case ["build-lookup", directory, geocodes, out]:
            from clearwell.operators import lookup
            from clearwell.sinks.files import lookup_csv
            from clearwell.sources import files

            print(lookup_csv(lookup.build(files.directory(spark, directory), files.geocodes(spark, geocodes)), out))
        case ["run", documents, page_rows, answers, out]:
            from clearwell.plans.ingest import ingest

            run = ingest(*(spark.read.parquet(x) for x in (documents, page_rows, answers)))
            for name in TABLES:
                getattr(run, name).write.mode("overwrite").parquet(f"{out}/{name}")
        case ["export", facts, lookup_path, out]:
            from datetime import UTC, datetime

            from clearwell.operators import reports
            from clearwell.sinks import files as sinks
            from clearwell.sources import files

            rows = spark.read.parquet(facts)
            if rows.isEmpty():
                raise RuntimeError("there are no measurements")
            exported, unmatched = reports.matched(rows, files.lookup(spark, lookup_path))
            print(sinks.export_csv(exported, out, datetime.now(UTC).strftime("%Y-%m-%d_%H%M%S")))
            sinks.unmatched_csv(unmatched, f"{out}/unmatched_schools.csv")
            sinks.copy_newest(spark, out)
        case ["summary", out]:
            for name in TABLES:
                print(name, spark.read.parquet(f"{out}/{name}").count())
            spark.read.parquet(f"{out}/issues").groupBy("issue_type").count().orderBy("issue_type").show(truncate=False)
        case ["query", name, sf_dir]:
            from clearwell.catalogue import QUERIES

            QUERIES[name](spark, sf_dir).show(50, truncate=80)
        case _:
            print(__doc__)
            return 2
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
