"""An ingest run: from documents, pages and recorded answers to facts, schools, issues, statuses and counters, each a DataFrame."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearwell.functions.names import hints
from clearwell.functions.text import or_empty
from clearwell.functions.values import exceeds
from clearwell.operators import files, pages, reports, schools, validation, verification


@dataclass(frozen=True)
class Run:
    accepted: DataFrame  #: the rows that pass the gate, with the school that they become
    issues: DataFrame  #: document_id, issue_type, detail
    schools: DataFrame  #: resolved_name, district, lab_name
    documents: DataFrame  #: document_id, counts, status, outcome
    counters: DataFrame  #: one row


def ingest(documents: DataFrame, page_rows: DataFrame, answers: DataFrame, findings: DataFrame | None = None, *, strict_source: bool = True) -> Run:
    """documents: document_id, file_path, file_hash, scan_idx, failed (could not be opened). page_rows: document_id, page_num, raw_text. answers: document_id,
    report_json. findings: the verifier's, document_id and their fields with flagged_rows; of documents that have any.

    The first file of each content counts. A report that does not parse is lost as a whole. Its district comes from the folder where it has none, then the verifier's
    corrections apply, and what they lower; the gate checks rows against the kept pages' text where no page is an image. A row's school and district come before its report's.
    """
    named = files.outcomes(files.first_of_content(documents))
    own = named.where("outcome = 'ingested'")
    kept = pages.kept(page_rows.join(own.select("document_id"), "document_id", "left_semi"))
    parsed = reports.parse(answers.join(own.select("document_id"), "document_id", "left_semi"), strict_source=strict_source)
    header = own.join(parsed.select("document_id", "valid", "report.school_name", "report.district", "report.lab_name"), "document_id", "left").withColumn("valid", F.coalesce("valid", F.lit(False)))
    district = F.expr("nullif(coalesce(nullif(district, ''), hint), '')")
    header = header.withColumn("hint", hints(F.col("file_path"))["district"]).withColumn("district", F.when(F.col("valid"), F.coalesce(district, "district"))).drop("hint")
    rows, raised = reports.exploded(parsed), []
    ask = verification.should_verify(rows, kept.groupBy("document_id").agg(F.count("*").alias("kept_pages"))).where("verify").select("document_id")
    if findings is not None:
        found = findings.join(ask, "document_id", "left_semi")
        header = verification.corrected(header, found)
        flagged = found.select("document_id", F.explode("flagged_rows.sample_id").alias("sample_id"))
        rows = verification.adjusted(rows, found.select("document_id", "is_multi_school", "school_attribution_correct", "overall_confidence"), flagged)
        rows = rows.withColumn("confidence", F.col("adjusted_confidence")).drop("adjusted_confidence", "is_multi_school", "school_attribution_correct", "overall_confidence")
        said = header.select("document_id", "renames").join(verification.issues(found).select("document_id", "issues"), "document_id")
        raised.append(said.select("document_id", F.lit("verification").alias("issue_type"), F.explode(F.concat("renames", "issues")).alias("detail")))
    gated = validation.gate(rows.join(validation.checkable(kept), "document_id", "left"), F.coalesce("report_text", F.lit("")), F.coalesce("spanned", F.lit(False)))
    held = validation.held_text(gated, F.coalesce("report_text", F.lit("")))
    raised.append(held.select("document_id", F.lit("needs_review").alias("issue_type"), "detail"))
    assigned = schools.assign(gated.where("decision = 'accept'").drop("report_text"), header)
    order = F.struct("scan_idx", "line_no")
    placed = assigned.join(own.select("document_id", "scan_idx"), "document_id")
    # a report's own school comes before its rows'
    heads = header.where(or_empty(F.col("school_name")) != "").select("school_name", "district", F.struct("scan_idx", F.lit(-1).alias("line_no")).alias("at"))
    firsts = heads.unionByName(placed.where(or_empty(F.col("school_name")) != "").select("school_name", "district", order.alias("at"))).groupBy("school_name", "district").agg(F.min("at").alias("at"))
    known = schools.resolve(firsts.withColumn("idx", F.col("at.scan_idx") * 1_000_000 + F.col("at.line_no")))
    known = known.select(F.col("school_name").alias("_s"), F.col("district").alias("_d"), "resolved_name")
    accepted = placed.join(known, F.col("school_name").eqNullSafe(F.col("_s")) & F.col("district").eqNullSafe(F.col("_d")), "left").drop("_s", "_d").withColumn("exceeds_action_level", exceeds(F.col("result_ppb"), F.col("action_level_ppb")))
    lab = F.expr("nullif(trim(lab_name), '')")
    dimension = accepted.where("resolved_name is not null").groupBy("resolved_name", "district").agg(F.min_by(lab, F.when(lab.isNotNull(), order)).alias("lab_name"))
    status = reports.status(header.withColumn("failed", F.col("failed") | ~F.col("valid")).select("document_id", "failed", "school_name", "valid"), schools.assign(gated.drop("lab_name"), header.select("document_id", "school_name", "district", "lab_name")))
    one = lambda which, kind, text: status.where(which).select("document_id", F.lit(kind).alias("issue_type"), F.lit(text).alias("detail"))
    raised += [one("not valid", "llm_error", "the answer does not match the schema"), one("valid and no_school", "no_school_found", "LLM did not return a school name."), one("valid and no_measurements", "no_measurements", "LLM returned no measurements for this report.")]
    issues = raised[0]
    for more in raised[1:]:
        issues = issues.unionByName(more)
    counted = named.select("document_id", "outcome").join(status.select("document_id", "written", "held", "no_school", "no_measurements", "status"), "document_id", "left")
    return Run(accepted, issues, dimension, counted, files.counters(named))
