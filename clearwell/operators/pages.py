"""Pages: classification by vocabulary, filtering, batches, report texts and digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearwell import fixed
from clearwell.functions.text import any_of, filled, matches, or_empty, strip


def label(text: Column, page_num: Column) -> Column:
    """keep for the first page; data from two words of the data vocabulary, or one and a number; else the first of the others that applies; else data."""
    t = strip(F.coalesce(text, F.lit("")))
    data = matches(t, fixed.DATA_TERMS)
    return (
        F.when(page_num == 0, "keep").when(data > 0, F.lit("data")).when(matches(t, fixed.CUSTODY_TERMS) >= 1, "coc")
        .when(t.rlike(any_of(fixed.LETTER_TERMS, words=False, flags="(?imU)")), "cover").when(matches(t, fixed.LABORATORY_TERMS) >= 2, "boilerplate")
        .when((F.length(t) < 300) & t.rlike(any_of(fixed.DIVIDER_TERMS)), "divider").when(F.length(t) < 30, "divider").otherwise("data")
    )


def is_blank(text: Column) -> Column:
    return strip(F.coalesce(text, F.lit(""))) == ""


def classify(pages: DataFrame) -> DataFrame:
    return pages.withColumn("is_blank", is_blank(F.col("raw_text"))).withColumn("label", label(F.col("raw_text"), F.col("page_num")))


def kept(pages: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """The pages that go on: the first, data pages, and blank ones unless an image label (document_id, page_num, image_label) says they are no table."""
    c = classify(pages)
    c = c.join(images, ["document_id", "page_num"], "left") if images is not None else c.withColumn("image_label", F.lit(None).cast("string"))
    blank = F.coalesce(~F.col("image_label").isin("coc", "cover", "boilerplate", "divider"), F.lit(True))
    return c.where((F.col("page_num") == 0) | F.when(F.col("is_blank"), blank).otherwise(F.col("label").isin("data", "keep")))


def batches(pages: DataFrame) -> DataFrame:
    """document_id, batch_no, first_page, last_page (from 1), pages: one batch of up to 12 text pages, or up to 4 image pages if any is an image; else two by two."""
    order = Window.partitionBy("document_id").orderBy("page_num")
    whole = Window.partitionBy("document_id")
    p = pages.withColumn("i", F.row_number().over(order) - 1).withColumn("n", F.count("*").over(whole)).withColumn("images", F.count_if("is_blank").over(whole))
    one = F.when(F.col("images") > 0, F.col("images") <= fixed.IMAGE_PAGES).otherwise(F.col("n") <= fixed.TEXT_PAGES)
    p = p.withColumn("batch_no", F.when(one, 0).otherwise(F.floor(F.col("i") / fixed.BATCH_PAGES)).cast("int"))
    return p.groupBy("document_id", "batch_no").agg((F.min("page_num") + 1).alias("first_page"), (F.max("page_num") + 1).alias("last_page"), F.count("*").alias("pages"), F.count_if("is_blank").alias("image_pages"))


def report_text(pages: DataFrame) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct("page_num", F.coalesce("raw_text", F.lit("")).alias("t"))))
    return pages.groupBy("document_id").agg(F.array_join(F.transform(rows, lambda x: x["t"]), "\n").alias("report_text"))


def digest(pages: DataFrame) -> DataFrame:
    """document_id, first_page, data_digest: the first page's beginning, and a line for each other page in order, until the budget of characters is used up.

    A page's line has its number and its beginning, cut to what is left of the budget, or says that it is a scan. When nothing is left, a last line tells how
    many pages there are beyond the lines. A page without text counts as a scan.
    """
    t = strip(F.coalesce("raw_text", F.lit("")))
    ordered = F.array_sort(F.collect_list(F.struct("page_num", t.alias("t"))))
    per = pages.groupBy("document_id").agg(ordered.alias("p"), F.max(F.when(F.col("page_num") == 0, F.substring(t, 1, fixed.FIRST_SNIPPET))).alias("first"))
    start = F.struct(F.array().cast("array<string>").alias("lines"), F.lit(0).alias("used"), F.lit(False).alias("full"))

    def add(acc: Column, x: Column) -> Column:
        at, left = F.concat(F.lit("[Page "), (x["page_num"] + 1).cast("string")), fixed.DIGEST - acc["used"]
        over = F.concat(F.lit("... and "), (F.size("p") - F.size(acc["lines"]) - 1).cast("string"), F.lit(" more pages"))
        line = F.when(x["t"] == "", F.concat(at, F.lit(": scanned image, no text]"))).when(left <= 0, over).otherwise(F.concat(at, F.lit("] "), F.substring(x["t"], F.lit(1), F.least(F.lit(fixed.PAGE_SNIPPET), left))))
        more = F.struct(F.concat(acc["lines"], F.array(line)).alias("lines"), (acc["used"] + F.length(line)).alias("used"), ((x["t"] != "") & (left <= 0)).alias("full"))
        return F.when(acc["full"] | (x["page_num"] == 0), acc).otherwise(more)

    lines = F.aggregate("p", start, add)["lines"]
    return per.select("document_id", or_empty(F.col("first"), F.lit(fixed.NO_FIRST_TEXT)).alias("first_page"), F.when(F.size(lines) > 0, F.array_join(lines, "\n")).otherwise(fixed.NO_PAGES).alias("data_digest"))


def first_filled(batch_headers: DataFrame, *columns: str) -> DataFrame:
    """By document the first value of each column, in the order of batch_no, that is neither null nor empty."""
    return batch_headers.groupBy("document_id").agg(*(F.min_by(filled(F.col(c)), F.when(filled(F.col(c)).isNotNull(), F.col("batch_no"))).alias(c) for c in columns))
