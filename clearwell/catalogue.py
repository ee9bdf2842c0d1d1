"""The registered queries of the report operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clearwell import fixed
from clearwell.functions import names, text, values
from clearwell.operators import files, lookup, pages, reports, schools, validation, verification
from clearwell.sources.views import duck, table, view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _with(*views: str, then: str) -> str:
    return f"WITH {duck(*views)} {then}"


# DuckDB's side of the expressions
ND = "(?i)" + fixed.NON_DETECT
_strip = lambda c: rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"
_norm = lambda c: _strip(rf"regexp_replace(lower(translate({c}, 'µμ', 'uu')), '\s+', ' ', 'g')")
_sep = lambda c: rf"regexp_replace(regexp_replace({_strip(c)}, '(\d),(\d{{3}})(\D|$)', '\1\2\3', 'g'), '(\d),(\d{{1,2}})(\D|$)', '\1.\2\3', 'g')"
_num = lambda c, p: f"try_cast(regexp_extract({c}, '{p}', 1) AS double)"
_in = lambda xs: "(" + ", ".join(f"'{x}'" for x in xs) + ")"
LESS, PLAIN = fixed.LESS_THAN, fixed.PLAIN_NUMBER
DERIVED = f"CASE WHEN regexp_matches({_sep('result_raw')}, '{ND}') THEN 0.0 ELSE coalesce({_num(_sep('result_raw'), LESS)}, {_num(_sep('result_raw'), PLAIN)}) * CASE WHEN {_norm('unit_raw')} IN ('mg/l', 'ppm') THEN 1000.0 ELSE 1.0 END END"
_unit = f"rtrim({_norm('unit_raw')}, '.,;: ')"
UNIT = f"CASE WHEN unit_raw IS NULL OR {_unit} = '' THEN 'none' WHEN {_unit} IN ('ug/l', 'ppb', 'ppb (ug/l)', 'ug/l (ppb)') THEN 'ppb' WHEN {_unit} IN ('mg/l', 'ppm') THEN 'scaled' WHEN {_unit} IN {_in(fixed.MISREAD_UNITS)} THEN 'misread' ELSE 'unknown' END"
RANGE = "list_filter([CASE WHEN result_ppb < 0 THEN 'negative' END, CASE WHEN result_ppb > 50000 THEN 'too_large' END], lambda x: x IS NOT NULL)"
MISMATCH = f"NOT (regexp_matches(result_raw, '{ND}') AND result_ppb BETWEEN 0 AND 5) AND abs(({DERIVED}) - result_ppb) > 0.51"
REASONS = f"""list_filter([CASE WHEN result_ppb < 0 THEN 'negative' END, CASE WHEN result_ppb > 50000 THEN 'too_large' END, CASE WHEN ({UNIT}) = 'unknown' THEN 'unit' END,
 CASE WHEN ({DERIVED}) IS NULL THEN 'no_number' END, CASE WHEN {MISMATCH} THEN 'mismatch' END, CASE WHEN confidence < 0.70 THEN 'confidence' END], lambda x: x IS NOT NULL)"""
GATED = f"g AS (SELECT *, array_to_string({REASONS}, ',') AS codes FROM a1)"


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measurements with the columns that the gate needs besides."""
    r = view(spark, sf_dir, "a1")
    return r.withColumns({"sample_id": F.concat(F.lit("S-"), "document_id", F.lit("-"), "line_no"), "sample_location": F.lit(None).cast("string"), "source_text": F.concat(F.lit("result "), "result_raw"), "action_level_ppb": F.lit(15.0)})


def _gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.gate(_rows(spark, sf_dir)).withColumn("codes", F.array_join("reasons", ","))


@query(_with("a1", then=f"SELECT document_id, line_no, result_raw, unit_raw, round({DERIVED}, 4) AS derived_ppb FROM a1"))
def q01_derive_ppb(spark, sf_dir):
    return view(spark, sf_dir, "a1").select("document_id", "line_no", "result_raw", "unit_raw", F.round(values.derived_ppb(F.col("result_raw"), F.col("unit_raw")), 4).alias("derived_ppb"))


@query(_with("a1", then=f"SELECT {UNIT} AS unit_kind, unit_raw, count(*) AS n FROM a1 GROUP BY ALL"))
def q02_unit_recognition(spark, sf_dir):
    return view(spark, sf_dir, "a1").groupBy(values.unit_kind(F.col("unit_raw")).alias("unit_kind"), "unit_raw").agg(F.count("*").alias("n"))


@query(_with("a1", then=f"SELECT regexp_matches(result_raw, '{ND}') AS non_detect, count(*) AS n FROM a1 GROUP BY ALL"))
def q03_non_detect_count(spark, sf_dir):
    return view(spark, sf_dir, "a1").groupBy(values.is_non_detect(F.col("result_raw")).alias("non_detect")).agg(F.count("*").alias("n"))


_ALTERED = "a1 AS (SELECT * REPLACE (CASE line_no % 3 WHEN 0 THEN -result_ppb WHEN 1 THEN result_ppb * 2000 ELSE result_ppb END AS result_ppb) FROM a)"


@query(f"WITH {duck('a1').replace('a1 AS', 'a AS', 1)}, {_ALTERED} SELECT document_id, line_no, result_ppb, array_to_string({RANGE}, ',') AS codes FROM a1")
def q04_range_check(spark, sf_dir):
    altered = F.expr("case line_no % 3 when 0 then -result_ppb when 1 then result_ppb * 2000 else result_ppb end")
    rows = _rows(spark, sf_dir).withColumn("result_ppb", altered)
    return rows.select("document_id", "line_no", "result_ppb", F.array_join(validation.range_codes(), ",").alias("codes"))


@query(_with("a1", then=f"SELECT document_id, line_no, result_raw, unit_raw, result_ppb FROM a1 WHERE {MISMATCH}"))
def q05_rederive_mismatch(spark, sf_dir):
    return validation.read(_rows(spark, sf_dir)).where(F.array_contains(validation.unit_codes(), "mismatch")).select("document_id", "line_no", "result_raw", "unit_raw", "result_ppb")


@query(_with("a1", then="SELECT confidence < 0.70 AS held, count(*) AS n FROM a1 GROUP BY ALL"))
def q06_confidence_gate(spark, sf_dir):
    return _rows(spark, sf_dir).groupBy((F.size(validation.confidence_codes()) > 0).alias("held")).agg(F.count("*").alias("n"))


@query(_with("a1", then=f", {GATED} SELECT document_id, line_no, codes FROM g"))
def q07_validation_reasons(spark, sf_dir):
    return _gated(spark, sf_dir).select("document_id", "line_no", "codes")


@query(_with("a1", then=f", {GATED} SELECT CASE WHEN codes = '' THEN 'accept' ELSE 'review' END AS decision, count(*) AS n FROM g GROUP BY ALL"))
def q08_accept_hold_split(spark, sf_dir):
    return _gated(spark, sf_dir).groupBy("decision").agg(F.count("*").alias("n"))


_PAGE = _norm("raw_text")


@query(_with("a4", then=f"SELECT document_id, page_num, contains({_PAGE}, '4.5') AS has_value, len(list_filter(['sample', 'id', 'result'], lambda t: NOT contains({_PAGE}, t))) = 0 AS has_place FROM a4"))
def q09_source_span(spark, sf_dir):
    rows = view(spark, sf_dir, "a4").withColumns({"result_raw": F.lit("4.5"), "sample_id": F.lit(None).cast("string"), "sample_location": F.lit("the Sample ID of a result")})
    codes = validation.span_codes(F.col("raw_text"))
    return rows.select("document_id", "page_num", (~F.array_contains(codes, "value_not_in_text")).alias("has_value"), (~F.array_contains(codes, "place_not_in_text")).alias("has_place"))


_VALUES = {"result": "result_ppb", "derived": f"({DERIVED})", "unit": "unit_raw", "raw": "result_raw", "confidence": "printf('%.2f', confidence)", "most": "'50000'", "least": "'0.70'", "level": "15.0", "place": "''", "missing": "''"}


def _said(words: str) -> str:
    """The DuckDB side of a reason's sentence."""
    parts = words.replace("}", "{").split("{")
    return "concat(" + ", ".join(_VALUES[x] if i % 2 else "'" + x.replace("'", "''") + "'" for i, x in enumerate(parts) if x) + ")"


SENTENCES = "CASE c " + " ".join(f"WHEN '{name}' THEN {_said(words)}" for name, words in fixed.REASONS.items()) + " END"


@query(_with("a1", then=f", {GATED} SELECT document_id, line_no, concat('Row held by validation (S-', document_id, '-', line_no, '): ', array_to_string(list_transform(string_split(codes, ','), lambda c: {SENTENCES}), '; ')) AS detail FROM g WHERE codes <> ''"))
def q10_hold_issue_text(spark, sf_dir):
    return validation.held_text(_gated(spark, sf_dir)).select("document_id", "line_no", "detail")


_T = _strip("coalesce(raw_text, '')")
_any = lambda terms: r"(?i)\b(" + "|".join(x for x in terms if "µ" not in x) + r")\b"
_n = lambda terms: f"len(regexp_extract_all({_T}, '{_any(terms)}'))"
LABEL = rf"""CASE WHEN page_num = 0 THEN 'keep' WHEN {_n(fixed.DATA_TERMS)} > 0 THEN 'data' WHEN {_n(fixed.CUSTODY_TERMS)} >= 1 THEN 'coc' WHEN regexp_matches({_T}, '(?im)({'|'.join(fixed.LETTER_TERMS)})') THEN 'cover'
 WHEN {_n(fixed.LABORATORY_TERMS)} >= 2 THEN 'boilerplate' WHEN length({_T}) < 300 AND regexp_matches({_T}, '{_any(fixed.DIVIDER_TERMS)}') THEN 'divider' WHEN length({_T}) < 30 THEN 'divider' ELSE 'data' END"""
LABELLED = f"l AS (SELECT *, {_T} = '' AS is_blank, {LABEL} AS label FROM a4)"
KEPT = "k AS (SELECT * FROM l WHERE page_num = 0 OR is_blank OR label IN ('data', 'keep'))"


@query(_with("a4", then=f", {LABELLED} SELECT document_id, page_num, label FROM l"))
def q11_page_classify(spark, sf_dir):
    return pages.classify(view(spark, sf_dir, "a4")).select("document_id", "page_num", "label")


@query(_with("a4", then=f", {LABELLED}, {KEPT} SELECT l.document_id, cast(count(k.page_num) AS bigint) AS kept, count(*) - count(k.page_num) AS dropped FROM l LEFT JOIN k USING (document_id, page_num) GROUP BY ALL"))
def q12_page_filter_counts(spark, sf_dir):
    every = view(spark, sf_dir, "a4")
    n = every.groupBy("document_id").agg(F.count("*").alias("n"))
    k = pages.kept(every).groupBy("document_id").agg(F.count("*").alias("kept"))
    return n.join(k, "document_id", "left").select("document_id", F.coalesce("kept", F.lit(0)).alias("kept"), (F.col("n") - F.coalesce("kept", F.lit(0))).alias("dropped"))


@query(_with("a4", then=f"SELECT document_id, count(*) AS page_count, count(*) FILTER ({_T} = '') AS blank_page_count FROM a4 GROUP BY ALL"))
def q13_page_blank_counts(spark, sf_dir):
    return view(spark, sf_dir, "a4").groupBy("document_id").agg(F.count("*").alias("page_count"), F.count_if(pages.is_blank(F.col("raw_text"))).alias("blank_page_count"))


@query(_with("a4", then=f", {LABELLED}, {KEPT}, t AS (SELECT document_id, string_agg(raw_text, chr(10) ORDER BY page_num) AS t FROM k GROUP BY ALL) SELECT document_id, length(t) AS n_chars, md5(t) AS digest FROM t"))
def q14_report_text(spark, sf_dir):
    t = pages.report_text(pages.kept(view(spark, sf_dir, "a4")))
    return t.select("document_id", F.length("report_text").cast("long").alias("n_chars"), F.md5("report_text").alias("digest"))


@query(_with("a4", then=f""", {LABELLED}, {KEPT}, w AS (SELECT *, row_number() OVER o - 1 AS i, count(*) OVER d AS n, count(*) FILTER (is_blank) OVER d AS im FROM k WINDOW o AS (PARTITION BY document_id ORDER BY page_num), d AS (PARTITION BY document_id)),
 b AS (SELECT *, CASE WHEN CASE WHEN im > 0 THEN im <= 4 ELSE n <= 12 END THEN 0 ELSE i // 2 END AS batch_no FROM w)
 SELECT document_id, cast(batch_no AS int) AS batch_no, min(page_num) + 1 AS first_page, max(page_num) + 1 AS last_page, count(*) AS pages, count(*) FILTER (is_blank) AS image_pages FROM b GROUP BY document_id, batch_no"""))
def q15_batch_plan(spark, sf_dir):
    return pages.batches(pages.kept(view(spark, sf_dir, "a4")))


_LINE = """CASE WHEN t = '' THEN concat('[Page ', page_num + 1, ': scanned image, no text]') WHEN used >= 2000 THEN concat('... and ', n - len(lines) - 1, ' more pages') ELSE concat('[Page ', page_num + 1, '] ', substr(t, 1, least(300, 2000 - used))) END"""


@query(f"""WITH RECURSIVE {duck('a4')}, b AS (SELECT document_id // 4 AS document_id, (document_id % 4) * 6 + page_num AS page_num, {_T} AS t FROM a4),
 p AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY page_num) AS i, count(*) OVER (PARTITION BY document_id) AS n FROM b),
 r AS (SELECT DISTINCT document_id, cast(0 AS bigint) AS i, cast([] AS varchar[]) AS lines, cast(0 AS bigint) AS used, false AS full_ FROM p UNION ALL
  SELECT p.document_id, p.i, CASE WHEN page_num = 0 THEN lines ELSE list_append(lines, {_LINE}) END, CASE WHEN page_num = 0 THEN used ELSE used + length({_LINE}) END, page_num > 0 AND t <> '' AND used >= 2000 FROM r JOIN p ON r.document_id = p.document_id AND p.i = r.i + 1 WHERE NOT full_),
 l AS (SELECT document_id, arg_max(lines, i) AS lines FROM r GROUP BY 1), f AS (SELECT document_id, max(substr(t, 1, 800)) FILTER (page_num = 0) AS head FROM p GROUP BY 1)
 SELECT document_id, CASE WHEN coalesce(head, '') = '' THEN '(scanned — no text available)' ELSE head END AS first_page, CASE WHEN len(lines) = 0 THEN '(no text pages)' ELSE array_to_string(lines, chr(10)) END AS data_digest FROM l JOIN f USING (document_id)""")
def q16_digest_snippets(spark, sf_dir):
    """Four documents as one, so that the budget runs out."""
    return pages.digest(view(spark, sf_dir, "a4").selectExpr("document_id div 4 as document_id", "cast((document_id % 4) * 6 + page_num as int) as page_num", "raw_text"))


@query("SELECT doc_id, sha256(text) AS file_hash, CASE WHEN doc_id = min(doc_id) OVER (PARTITION BY sha256(text)) THEN 'ingested' ELSE 'skipped' END AS outcome FROM documents")
def q17_content_dedup(spark, sf_dir):
    f = table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("file_hash"))
    return files.first_of_content(f, "doc_id").select("doc_id", "file_hash", "outcome")


@query("SELECT doc_id FROM documents WHERE source <> 'src0' AND sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE source = 'src0')")
def q18_incremental_skip(spark, sf_dir):
    f = table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2(F.col("text").cast("binary"), 256).alias("file_hash"))
    return files.unseen(f.where("source <> 'src0'"), f.where("source = 'src0'").withColumn("status", F.lit("ok"))).select("doc_id")


_NAME = "regexp_extract(url, '^https?://([^/]+)', 1)"


@query(f"WITH p AS (SELECT page_id AS id, {_NAME} AS name, url LIKE 'https:%' AS local FROM pages) SELECT id, name FROM p WHERE NOT local AND lower(name) NOT IN (SELECT lower(name) FROM p WHERE local)")
def q19_name_anti_join(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.regexp_extract("url", "^https?://([^/]+)", 1).alias("name"), F.col("url").startswith("https:").alias("local"))
    return files.unseen_names(p.where("not local").drop("local"), p.where("local"))


_STATE = "upper(trim(LSTATE)) = 'NJ'"
_GEO = "upper(trim(STATE)) = 'NJ' AND trim(NCESSCH) <> '' AND LAT IS NOT NULL AND LON IS NOT NULL"
_LAST = f"geo AS (SELECT trim(NCESSCH) AS k, cast(arg_max(LAT, file_row) AS double) AS latitude, cast(arg_max(LON, file_row) AS double) AS longitude FROM a3g WHERE {_GEO} GROUP BY 1)"


@query(_with("a3d", then=f"SELECT NCESSCH, SCH_NAME, LEA_NAME, LSTATE FROM a3d WHERE {_STATE}"))
def q20_state_filter(spark, sf_dir):
    return lookup.in_state(view(spark, sf_dir, "a3d")).select("NCESSCH", "SCH_NAME", "LEA_NAME", "LSTATE")


_LOOKUP = f"""{_LAST}, lk AS (SELECT trim(NCESSCH) AS nces_id, trim(SCH_NAME) AS school_name, trim(LEA_NAME) AS district_name, '' AS county,
 concat_ws(', ', nullif(trim(LSTREET1), ''), nullif(trim(LSTREET2), ''), nullif(trim(LCITY), ''), nullif(trim(LSTATE), ''), nullif(trim(LZIP), '')) AS address, latitude, longitude
 FROM a3d LEFT JOIN geo ON trim(NCESSCH) = k WHERE {_STATE})"""


@query(_with("a3d", "a3g", then=f", {_LOOKUP} SELECT nces_id, round(latitude, 4) AS latitude, round(longitude, 4) AS longitude FROM lk"))
def q21_lookup_left_join_last_wins(spark, sf_dir):
    lk = lookup.build(view(spark, sf_dir, "a3d"), view(spark, sf_dir, "a3g"))
    return lk.select("nces_id", F.round("latitude", 4).alias("latitude"), F.round("longitude", 4).alias("longitude"))


@query(_with("a3d", "a3g", then=f", {_LOOKUP} SELECT nces_id, address FROM lk"))
def q22_address_concat(spark, sf_dir):
    return lookup.build(view(spark, sf_dir, "a3d"), view(spark, sf_dir, "a3g")).select("nces_id", "address")


_gsub = lambda c, p, r=" ": f"regexp_replace({c}, '{p}', '{r}', 'g')"
_tidy = lambda c: _strip(_gsub(_gsub(c, r"[^\w\s]"), r"\s+"))
SCHOOL = f"coalesce({_tidy(_gsub(_gsub('lower(school_name)', _any([fixed.SCHOOL_SUFFIXES])), _any(fixed.SCHOOL_FILLERS)))}, '')"
_district = _strip("lower(district)")
for _short, _long in fixed.DISTRICT_WORDS.items():
    _district = _gsub(_district, _any([_short]), _long)
_END = r"\s*#?\d+$"
DISTRICT = f"coalesce({_strip(_gsub(_tidy(_gsub(_district, _any(fixed.DISTRICT_NOISE))), _END, ''))}, '')"
_number = lambda patterns: "coalesce(" + ", ".join(f"try_cast(regexp_extract(school_name, '(?i){p}', 1) AS int)" for p in patterns) + ")"


@query(_with("a3", then=f"SELECT school_key, school_name, {SCHOOL} AS normalized FROM a3"))
def q23_norm_school(spark, sf_dir):
    return view(spark, sf_dir, "a3").select("school_key", "school_name", names.normal_school(F.col("school_name")).alias("normalized"))


@query(_with("a3", then=f"SELECT school_key, district, {DISTRICT} AS normalized FROM a3"))
def q24_norm_district(spark, sf_dir):
    return view(spark, sf_dir, "a3").select("school_key", "district", names.normal_district(F.col("district")).alias("normalized"))


@query(_with("a3", then=f"SELECT school_key, {_number(fixed.NUMBERED)} AS match_number, {_number(fixed.NUMBERED[:2])} AS ingest_number FROM a3"))
def q25_school_number(spark, sf_dir):
    return view(spark, sf_dir, "a3").select("school_key", names.school_number(F.col("school_name")).alias("match_number"), names.ingest_number(F.col("school_name")).alias("ingest_number"))


_PAIRS = f"n AS (SELECT *, {_number(fixed.NUMBERED)} AS num FROM a3), p AS (SELECT a.school_key AS key, b.school_key AS cand, a.num AS number, b.num AS cand_number FROM n a JOIN n b ON a.district = b.district AND a.school_key <> b.school_key)"


@query(_with("a3", then=f", {_PAIRS}, f AS (SELECT *, max(coalesce(number = cand_number, false)) OVER (PARTITION BY key) AS has FROM p) SELECT key, cand, number, cand_number FROM f WHERE CASE WHEN has THEN coalesce(number = cand_number, false) ELSE cand_number IS NULL END"))
def q26_numeric_identity_filter(spark, sf_dir):
    n = view(spark, sf_dir, "a3").select("school_key", "district", names.school_number(F.col("school_name")).alias("num"))
    a, b = n.toDF("key", "district", "number"), n.toDF("cand", "district", "cand_number")
    return lookup.identity(a.join(b, "district").where("key <> cand")).select("key", "cand", "number", "cand_number")


@query()
def q27_fuzzy_match_top1(spark, sf_dir):
    lk = lookup.build(view(spark, sf_dir, "a3d"), view(spark, sf_dir, "a3g"))
    return lookup.match(view(spark, sf_dir, "a3"), lk).select("school_name", "district", "nces_id", F.col("name").alias("matched_name"), F.round("score", 4).alias("score"))


_NAMED = "CASE WHEN document_id % 50 = 0 AND line_no = 1 THEN 'Own School' END"


@query(_with("a1", then=f""", r AS (SELECT *, {_NAMED} AS school_name FROM a1), m AS (SELECT document_id, count(*) AS n_rows, avg(confidence + 0.003) AS mean_confidence, bool_or(coalesce(school_name, '') <> '') AS row_school FROM r GROUP BY 1),
 o AS (SELECT o_orderkey AS document_id, o_orderkey % 9 AS kept_pages FROM orders)
 SELECT document_id, CASE WHEN n_rows IS NULL THEN false WHEN row_school THEN true ELSE NOT (kept_pages <= 6 AND mean_confidence >= 0.85 AND n_rows <= 50) END AS verify FROM o LEFT JOIN m USING (document_id)"""))
def q28_should_verify(spark, sf_dir):
    # no mean lies at the threshold, where sums of doubles differ by their order
    rows = view(spark, sf_dir, "a1").withColumn("school_name", F.expr(_NAMED)).withColumn("confidence", F.col("confidence") + 0.003)
    kept = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("document_id"), (F.col("o_orderkey") % 9).alias("kept_pages"))
    return verification.should_verify(rows, kept).select("document_id", "verify")


@query(_with("a1", "a5", then="""SELECT a1.document_id, line_no, confidence, least(confidence, CASE WHEN is_multi_school AND NOT school_attribution_correct THEN 0.5 END, CASE WHEN line_no = flagged_line_no THEN 0.5 END,
 CASE WHEN overall_confidence < 0.8 THEN cast(overall_confidence AS double) END) AS adjusted_confidence FROM a1 LEFT JOIN a5 ON a1.document_id = a5.document_id"""))
def q29_verification_adjust(spark, sf_dir):
    rows = view(spark, sf_dir, "a1").withColumn("sample_id", F.col("line_no").cast("string"))
    found = view(spark, sf_dir, "a5")
    flagged = found.select("document_id", F.col("flagged_line_no").cast("string").alias("sample_id"))
    return verification.adjusted(rows, found, flagged).select("document_id", "line_no", "confidence", "adjusted_confidence")


@query(_with("a5", then="""SELECT document_id, array_to_string(list_filter([CASE WHEN is_multi_school AND NOT school_attribution_correct THEN 'Multi-school report with incorrect school attribution; all rows downgraded to 0.50 confidence' END,
 CASE WHEN overall_confidence < 0.8 THEN printf('Verifier overall confidence low (%.2f); all rows downgraded', cast(overall_confidence AS double)) END, CASE WHEN missed_count > 0 THEN concat('Verifier estimates ', missed_count, ' measurement(s) missed by extractor') END,
 concat('Flagged row ', flagged_line_no, ': check value')], lambda x: x IS NOT NULL), ' | ') AS issues FROM a5"""))
def q30_verify_issue_list(spark, sf_dir):
    found = view(spark, sf_dir, "a5").withColumn("flagged_rows", F.array(F.struct(F.col("flagged_line_no").cast("string").alias("sample_id"), F.lit("check value").alias("issue"))))
    return verification.issues(found).select("document_id", F.array_join("issues", " | ").alias("issues"))


def _facts(spark: SparkSession, sf_dir: str, accepted: bool = True) -> DataFrame:
    rows = _gated(spark, sf_dir)
    return reports.joined(rows.where("decision = 'accept'") if accepted else rows, view(spark, sf_dir, "a3").withColumnRenamed("county", "school_county"), view(spark, sf_dir, "a2"))


_FACTS = f"{GATED}, f AS (SELECT g.*, a3.school_name, a3.district, a2.file_name, a2.file_path, a2.sample_date FROM g LEFT JOIN a3 USING (school_key) JOIN a2 ON g.document_id = a2.document_id WHERE codes = '')"
_COUNTY = r"""coalesce(regexp_replace(list_filter(string_split(file_path, '/'), lambda p: lower(p) LIKE '% county')[1], ' [Cc]ounty', '', 'g'), '')"""


@query(_with("a1", "a2", "a3", "a3d", "a3g", then=f""", {_FACTS}, {_LOOKUP}, ids AS (SELECT trim(NCESSCH) AS nces_id, cast(NCESSCH AS bigint) AS k FROM a3d),
 m AS (SELECT f.*, lk.nces_id, lk.school_name AS ms, lk.district_name AS md, lk.address, lk.latitude, lk.longitude FROM f LEFT JOIN (SELECT lk.*, k FROM lk JOIN ids USING (nces_id)) lk ON f.school_key = lk.k)
 SELECT {_COUNTY} AS county, coalesce(md, district, '') AS district, coalesce(ms, school_name, '') AS school_name, coalesce(address, '') AS address, CASE WHEN latitude IS NULL THEN '' ELSE 'known' END AS coordinates,
 concat('S-', document_id, '-', line_no) AS sample_id, '' AS sample_location, '' AS fixture_type, '' AS draw_type, strftime(sample_date, '%Y-%m-%d') AS sample_date, cast(year(sample_date) AS varchar) AS year,
 result_ppb AS lead_concentration_ppb, confidence, line_no AS source_page, file_name AS source_file, result_ppb > 15.0 AS exceeds FROM m"""))
def q31_export_join(spark, sf_dir):
    """The enriched export, with the exceedance flag; the lookup joins by the directory's key, coordinates are told as known or not (texts of doubles differ between engines)."""
    lk = lookup.build(view(spark, sf_dir, "a3d"), view(spark, sf_dir, "a3g")).withColumnsRenamed({"school_name": "name", "rec_idx": "school_key"})
    nothing = F.lit(None).cast("string")
    facts = _facts(spark, sf_dir).withColumns({"fixture_type": nothing, "draw_type": nothing, "source_page": F.col("line_no"), "test_year": F.lit(None).cast("int")})
    e = reports.export(facts, lk, on=("school_key",)).withColumn("exceeds", values.exceeds(F.col("lead_concentration_ppb"), F.lit(15.0)))
    return e.withColumn("coordinates", F.when(F.col("coordinates") == "", "").otherwise("known"))


@query(_with("a1", "a2", "a3", then=f", {_FACTS} SELECT school_key, school_name, count(*) AS n, count(*) FILTER (result_ppb > 15.0) AS n_exceeding, max(result_ppb) AS max_ppb FROM f GROUP BY ALL"))
def q32_exceedance_by_school(spark, sf_dir):
    return _facts(spark, sf_dir).groupBy("school_key", "school_name").agg(F.count("*").alias("n"), F.count_if(values.exceeds(F.col("result_ppb"), F.lit(15.0))).alias("n_exceeding"), F.max("result_ppb").alias("max_ppb"))


@query(_with("a1", "a2", "a3", then=f", {_FACTS} SELECT school_name, coalesce(district, '') AS district, count(*) AS measurements, array_to_string(list_sort(list(DISTINCT file_name))[1:5], '; ') AS example_files FROM f WHERE school_name IS NOT NULL AND document_id % 3 = 0 GROUP BY ALL"))
def q33_unmatched_tally(spark, sf_dir):
    return reports.unmatched(_facts(spark, sf_dir).where("document_id % 3 = 0"))


@query(_with("a1", then=f""", {GATED}, p AS (SELECT document_id, count(*) FILTER (codes = '') AS written, count(*) FILTER (codes <> '') AS held, bool_or(codes = '' AND document_id % 3 = 0) AS row_school FROM g GROUP BY 1),
 d AS (SELECT o_orderkey AS document_id, o_orderkey % 97 = 0 AS failed, CASE WHEN o_orderkey % 4 <> 0 THEN 'School' END AS school_name, coalesce(written, 0) AS written, coalesce(held, 0) AS held, coalesce(row_school, false) AS rs FROM orders LEFT JOIN p ON o_orderkey = document_id),
 s AS (SELECT *, NOT rs AND school_name IS NULL AS no_school, written = 0 AND held = 0 AS no_measurements FROM d)
 SELECT document_id, written, held, no_school, no_measurements, CASE WHEN failed THEN 'failed' WHEN (no_school OR no_measurements OR held > 0) AND written > 0 THEN 'partial' WHEN no_school OR no_measurements OR held > 0 THEN 'failed' ELSE 'ok' END AS status FROM s"""))
def q34_document_status(spark, sf_dir):
    docs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("document_id"), (F.col("o_orderkey") % 97 == 0).alias("failed"), F.expr("case when o_orderkey % 4 <> 0 then 'School' end").alias("school_name"))
    gated = _gated(spark, sf_dir).withColumn("school_name", F.expr("case when document_id % 3 = 0 then 'Own' end"))
    return reports.status(docs, gated).select("document_id", "written", "held", "no_school", "no_measurements", "status")


@query(_with("a2", then="SELECT document_id, file_name, ingested_at FROM a2 ORDER BY ingested_at DESC, document_id LIMIT 50"))
def q35_recent_documents(spark, sf_dir):
    return reports.recent(view(spark, sf_dir, "a2")).select("document_id", "file_name", "ingested_at")


@query(_with("a1", "a2", "a3", "a4", then=f""", {GATED} SELECT 'measurements' AS name, '' AS kind, count(*) AS n FROM a1 UNION ALL SELECT 'documents', '', count(*) FROM a2 UNION ALL SELECT 'schools', '', count(*) FROM a3 UNION ALL SELECT 'pages', '', count(*) FROM a4
 UNION ALL SELECT 'issues', kind, count(*) FROM (SELECT unnest(string_split(codes, ',')) AS kind FROM g WHERE codes <> '') GROUP BY kind"""))
def q36_table_summary(spark, sf_dir):
    parts = [view(spark, sf_dir, v).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), F.lit("").alias("kind"), "n") for name, v in (("measurements", "a1"), ("documents", "a2"), ("schools", "a3"), ("pages", "a4"))]
    issues = _gated(spark, sf_dir).select(F.explode("reasons").alias("kind")).groupBy("kind").agg(F.count("*").alias("n")).select(F.lit("issues").alias("name"), "kind", "n")
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3]).union(issues)


_HEAD = "CASE WHEN (document_id + page_num) % 3 = 0 THEN '' WHEN (document_id + page_num) % 3 = 1 THEN NULL ELSE concat('School ', page_num) END"


@query(_with("a4", then=f", h AS (SELECT document_id, page_num, {_HEAD} AS school_name FROM a4) SELECT document_id, arg_min(school_name, page_num) FILTER (school_name <> '') AS school_name FROM h GROUP BY 1"))
def q37_first_nonempty_header(spark, sf_dir):
    h = view(spark, sf_dir, "a4").select("document_id", F.col("page_num").alias("batch_no"), F.expr(_HEAD).alias("school_name"))
    return pages.first_filled(h, "school_name")


@query()
def q38_school_dedup_ordered(spark, sf_dir):
    return schools.resolve(view(spark, sf_dir, "a3").withColumn("idx", F.col("school_key").cast("long")))


@query(_with("a6", then="""SELECT document_id, json_extract_string(report_json, '$.school_name') AS school_name, cast(json_extract(report_json, '$.measurements[0].confidence') AS double) BETWEEN 0 AND 1 AS valid,
 json_extract_string(report_json, '$.measurements[0].sample_id') AS sample_id FROM a6"""))
def q39_report_json_parse(spark, sf_dir):
    p = reports.parse(view(spark, sf_dir, "a6"), strict_source=False)
    return p.select("document_id", "report.school_name", "valid", F.get("report.measurements", F.lit(0))["sample_id"].alias("sample_id"))


@query(_with("a3", then=r"""SELECT school_key, list_aggregate(list_transform(range(1, length(school_name) + 1), lambda i: CASE WHEN i = 1 OR NOT regexp_matches(school_name[i - 1], '^\pL$') THEN upper(school_name[i]) ELSE lower(school_name[i]) END), 'string_agg', '') AS titled FROM a3"""))
def q40_title_case(spark, sf_dir):
    return view(spark, sf_dir, "a3").select("school_key", text.title(F.col("school_name")).alias("titled"))


_LASTC = "list_filter(range(1, len(p) + 1), lambda i: lower(p[i]) LIKE '% county')"


@query(_with("a2", then=rf""", s AS (SELECT document_id, string_split(file_path, '/') AS p FROM a2), c AS (SELECT *, list_max({_LASTC}) AS i FROM s)
 SELECT document_id, coalesce(regexp_replace(p[i], ' [Cc]ounty', '', 'g'), '') AS county, coalesce(trim(regexp_replace(p[i + 1], '(?i)\s*[-–]\s*(\d{{2,4}}[-–]\d{{2,4}}\s*parsed|fully\s*parsed|parsed)', '', 'g')), '') AS district, '' AS lab,
 coalesce(regexp_replace(p[list_min({_LASTC})], ' [Cc]ounty', '', 'g'), '') AS export_county FROM c"""))
def q41_path_hints(spark, sf_dir):
    return view(spark, sf_dir, "a2").select("document_id", names.hints(F.col("file_path")).alias("h"), names.county(F.col("file_path")).alias("export_county")).select("document_id", "h.*", "export_county")


@query(_with("a1", "a2", "a3", then=f", {_FACTS}, n AS (SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY document_id, line_no, result_raw, result_ppb, unit_raw, school_key, confidence) AS i FROM f) SELECT file_name, count(*) AS n, min(i) AS lo, max(i) AS hi FROM n GROUP BY 1"))
def q42_export_numbering(spark, sf_dir):
    """The export's order within a file, as row numbers by file."""
    w = Window.partitionBy("file_name").orderBy("document_id", "line_no", "result_raw", "result_ppb", "unit_raw", "school_key", "confidence")
    return _facts(spark, sf_dir).withColumn("i", F.row_number().over(w)).groupBy("file_name").agg(F.count("*").alias("n"), F.min("i").cast("long").alias("lo"), F.max("i").cast("long").alias("hi"))


def _export_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return _facts(spark, sf_dir).withColumns({"fixture_type": nothing, "draw_type": nothing, "source_page": F.col("line_no"), "test_year": F.lit(None).cast("int")})


@query()
def q43_export_matched(spark, sf_dir):
    """The export with each school matched to the lookup by its name. The scores have no SQL."""
    return reports.matched(_export_facts(spark, sf_dir), lookup.build(view(spark, sf_dir, "a3d"), view(spark, sf_dir, "a3g")))[0]


@query()
def q44_unmatched_schools(spark, sf_dir):
    return reports.matched(_export_facts(spark, sf_dir), lookup.build(view(spark, sf_dir, "a3d"), view(spark, sf_dir, "a3g")))[1]


_NAMES = ("CASE WHEN o_orderkey % 4 > 0 THEN concat('School ', cast(o_orderkey % 40 AS varchar(5))) END AS school_name", "CASE WHEN o_orderkey % 7 > 0 THEN 'Alden' END AS district")
_FOUND = (
    "o_orderkey % 3 <> 0 AS school_name_correct", "CASE o_orderkey % 9 WHEN 0 THEN ' New School ' WHEN 3 THEN 'NS' WHEN 6 THEN repeat('x', 61) ELSE 'Right School' END AS school_name_suggested",
    "CASE WHEN o_orderkey % 5 > 0 THEN true END AS district_correct", "CASE WHEN o_orderkey % 2 = 0 THEN 'North District' END AS district_suggested",
)
_NEW = lambda c: f"CASE WHEN NOT coalesce({c}_correct, false) AND length(trim({c}_suggested)) BETWEEN 3 AND 60 THEN trim({c}_suggested) END"
_SAID = lambda title, old, new: f"CASE WHEN {new} IS NOT NULL THEN concat('{title} corrected: ', chr(39), coalesce({old}, 'None'), chr(39), ' -> ', chr(39), {new}, chr(39)) END"


@query(f"""WITH n AS (SELECT o_orderkey AS document_id, {', '.join(_NAMES + _FOUND)} FROM orders), w AS (SELECT *, {_NEW('school_name')} AS s, {_NEW('district')} AS d FROM n)
 SELECT document_id, coalesce(s, school_name) AS school_name, coalesce(d, district) AS district,
 array_to_string(list_filter([{_SAID('School name', 'school_name', 's')}, {_SAID('District', 'district', 'd')}], lambda x: x IS NOT NULL), ' | ') AS renames FROM w""")
def q45_verify_renames(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    fixed_names, found = (orders.selectExpr("o_orderkey AS document_id", *x) for x in (_NAMES, _FOUND))
    return verification.corrected(fixed_names, found).select("document_id", "school_name", "district", F.array_join("renames", " | ").alias("renames"))


@query(_with("a1", then="""SELECT document_id, CASE WHEN len(s) > 0 THEN array_to_string(s, ', ') ELSE '(all under report-level school)' END AS unique_schools FROM
 (SELECT document_id, coalesce(list_sort(list(DISTINCT concat('School ', school_key % 10)) FILTER (line_no % 2 = 0)), []) AS s FROM a1 GROUP BY 1)"""))
def q46_row_schools(spark, sf_dir):
    return verification.row_schools(view(spark, sf_dir, "a1").selectExpr("document_id", "case when line_no % 2 = 0 then concat('School ', school_key % 10) when line_no % 3 = 0 then '' end as school_name"))


@query(_with("a3d", "a3g", then=f""", o AS (SELECT trim(NCESSCH) AS k FROM a3d WHERE {_STATE}), g AS (SELECT trim(NCESSCH) AS k FROM a3g WHERE {_GEO})
 SELECT (SELECT count(*) FROM a3d) AS directory_rows, (SELECT count(*) FROM o) AS directory_kept, (SELECT count(*) FROM a3g) AS geocode_rows, (SELECT count(*) FROM g) AS geocode_kept,
 (SELECT count(*) FROM o WHERE k IN (SELECT k FROM g)) AS joined"""))
def q47_lookup_counts(spark, sf_dir):
    return lookup.kept_counts(view(spark, sf_dir, "a3d"), view(spark, sf_dir, "a3g"))


@query("""WITH d AS (SELECT doc_id, CASE WHEN doc_id = min(doc_id) OVER (PARTITION BY sha256(text)) THEN CASE WHEN doc_id % 10 = 0 THEN 'failed' ELSE 'ingested' END ELSE 'skipped' END AS outcome FROM documents)
 SELECT count(*) FILTER (outcome = 'ingested') AS ingested, count(*) FILTER (outcome = 'skipped') AS skipped, count(*) FILTER (outcome = 'failed') AS failed, count(*) AS total FROM d""")
def q48_run_counters(spark, sf_dir):
    f = table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("file_hash"), (F.col("doc_id") % 10 == 0).alias("failed"))
    return files.counters(files.outcomes(files.first_of_content(f, "doc_id")))
