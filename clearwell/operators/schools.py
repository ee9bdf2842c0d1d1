"""Schools on ingest: names resolved in the order they come, district by district."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearwell import fixed
from clearwell.functions.fuzzy import weighted
from clearwell.functions.names import ingest_number
from clearwell.functions.text import filled, strip, title

RESOLVED = "school_name string, district string, first_idx long, resolved_name string, created boolean"


def resolve(names: DataFrame, *, number_conflict: str = "reference") -> DataFrame:
    """(school_name, district, idx) to distinct names with the school they become.

    Within a district, in the order of each name's first row: an equal title-cased name, else the first school of the same number,
    else the best score of 88 or more, else a new school. The result depends on that order, so each district is one group; what
    is grouped are the distinct names with their first place, and the scores run in one Python task a district.
    number_conflict: reference lets names of different numbers merge by score (School 10, School 11), strict does not.
    """
    clean = names.where(filled(F.col("school_name")).isNotNull()).groupBy("school_name", "district").agg(F.min("idx").alias("first_idx"))
    clean = clean.withColumn("name", title(strip(F.col("school_name")))).withColumn("place", filled(title(strip(F.col("district"))))).withColumn("number", ingest_number(F.col("name")))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        known: list[tuple[str, int | None]] = []
        out = []
        for r in pdf.sort_values(["first_idx", "school_name"]).itertuples():
            number = None if pd.isna(r.number) else int(r.number)
            found = next((n for n, _ in known if n == r.name), None)
            if found is None and number is not None:
                found = next((n for n, k in known if k == number), None)
            if found is None:
                scores = [(weighted(r.name, n), -i, n) for i, (n, k) in enumerate(known) if number_conflict == "reference" or k is None or number is None or k == number]
                best = max(scores, default=(0.0, 0, ""))
                found = best[2] if best[0] >= fixed.INGEST_SCORE else None
            out.append((r.school_name, r.district, r.first_idx, found or r.name, found is None))
            if found is None:
                known.append((r.name, number))
        return pd.DataFrame(out, columns=["school_name", "district", "first_idx", "resolved_name", "created"])

    return clean.groupBy("place").applyInPandas(one, RESOLVED)


def assign(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """rows with the school and district that count: their own, else their report's; and the lab of each school, from its first row that has one."""
    r = rows.join(reports.select("document_id", F.col("school_name").alias("_s"), F.col("district").alias("_d"), "lab_name"), "document_id", "left")
    return r.withColumn("school_name", F.coalesce(filled(F.col("school_name")), "_s")).withColumn("district", F.coalesce(filled(F.col("district")), "_d")).drop("_s", "_d")


def labs(assigned: DataFrame) -> DataFrame:
    lab = filled(F.col("lab_name"))
    return assigned.groupBy("school_name", "district").agg(F.min_by(lab, F.when(lab.isNotNull(), F.struct("document_id", "line_no"))).alias("lab_name"))
