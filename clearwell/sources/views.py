"""The driver's tables in the shape of report data; each statement is the same text in Spark and in DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: 25 town words of five letters.
TOWNS = "'AldenBrickCedarDoverEltonFroomGroveHavenIslipJuneaKeltyLumenMaconNyackOpalsPeruxQuartRovenSalemTroyaUnionVenusWylieXeniaYonke'"


def town(n: str) -> str:
    return f"substr({TOWNS}, cast({n} AS int) * 5 + 1, 5)"


HOME = "FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey"
VIEWS = {
    "a1": """SELECT l_orderkey AS document_id, l_linenumber AS line_no, l_suppkey AS school_key,
 CASE (l_orderkey + l_linenumber) % 8 WHEN 0 THEN 'ND' WHEN 1 THEN '<1.00' WHEN 2 THEN '2,260' WHEN 3 THEN '4,76' WHEN 4 THEN 'pending'
  WHEN 5 THEN concat('0.0', cast(l_linenumber AS varchar(10))) ELSE cast(cast(l_quantity AS int) AS varchar(10)) END AS result_raw,
 CASE (l_orderkey + l_suppkey) % 7 WHEN 0 THEN 'ug/L' WHEN 1 THEN 'ppb' WHEN 2 THEN 'mg/L' WHEN 3 THEN 'pg/L' WHEN 4 THEN 'ug/L.' WHEN 5 THEN 'gallons' ELSE NULL END AS unit_raw,
 cast(l_quantity AS double) AS result_ppb, round(1.0 - l_discount * 4, 2) AS confidence FROM {lineitem}""",
    "a2": """SELECT o_orderkey AS document_id, concat('report_', cast(o_orderkey AS varchar(20)), '.pdf') AS file_name,
 concat('/data/', r_name, CASE o_orderkey % 4 WHEN 0 THEN ' County' WHEN 1 THEN ' county' WHEN 2 THEN ' COUNTY' ELSE '' END, '/', n_name,
  CASE o_orderkey % 3 WHEN 0 THEN ' - 19-20 parsed' WHEN 1 THEN ' - fully parsed' ELSE '' END, '/report_', cast(o_orderkey AS varchar(20)), '.pdf') AS file_path,
 cast(o_orderdate AS date) AS ingested_at, cast(o_orderdate AS date) AS sample_date
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "a3": f"""SELECT s_suppkey AS school_key,
 CASE s_suppkey % 6 WHEN 0 THEN concat('PS #', cast(s_suppkey % 40 AS varchar(5))) WHEN 1 THEN concat('public school no. ', cast(s_suppkey % 40 AS varchar(5)))
  WHEN 2 THEN concat('P.S. ', cast(s_suppkey % 40 AS varchar(5))) WHEN 3 THEN concat({town("(s_suppkey * 3) % 25")}, ' Elementary School')
  WHEN 4 THEN concat('o''', lower({town("(s_suppkey * 7) % 25")}), ' Middle School') ELSE NULL END AS school_name,
 CASE s_suppkey % 4 WHEN 0 THEN concat({town("n_nationkey")}, ' Boe') WHEN 1 THEN concat({town("n_nationkey")}, ' Township Board of Education')
  WHEN 2 THEN concat('City of ', {town("n_nationkey")}, ' School District #9041') ELSE NULL END AS district, r_name AS county
{HOME} JOIN {{region}} ON n_regionkey = r_regionkey""",
    "a3d": f"""SELECT concat(' ', lpad(cast(s_suppkey AS varchar(12)), 12, '0'), ' ') AS NCESSCH,
 CASE WHEN s_suppkey % 6 < 3 THEN concat('School ', cast(s_suppkey % 40 AS varchar(5))) WHEN s_suppkey % 6 = 3 THEN concat({town("(s_suppkey * 3) % 25")}, ' School') ELSE concat('O''', {town("(s_suppkey * 7) % 25")}, ' Middle') END AS SCH_NAME,
 concat({town("n_nationkey")}, ' Public School District') AS LEA_NAME, concat(cast(s_suppkey AS varchar(9)), ' Main St') AS LSTREET1,
 CASE WHEN s_suppkey % 2 = 0 THEN ' ' ELSE 'Suite 1' END AS LSTREET2, {town("n_nationkey")} AS LCITY,
 CASE s_suppkey % 5 WHEN 0 THEN ' nj ' WHEN 1 THEN 'PA' ELSE 'NJ' END AS LSTATE, lpad(cast(7000 + s_suppkey AS varchar(5)), 5, '0') AS LZIP, s_suppkey AS rec_idx {HOME}""",
    "a3g": """SELECT c_custkey AS file_row, lpad(cast(c_custkey % 130 AS varchar(12)), 12, '0') AS NCESSCH, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 40.0 + (c_custkey % 100) / 100.0 END AS LAT,
 -74.0 - (c_custkey % 90) / 100.0 AS LON, CASE WHEN c_custkey % 9 = 0 THEN 'NY' ELSE 'NJ' END AS STATE FROM {customer}""",
    "a4": """SELECT cast(floor(doc_id / 6) AS bigint) AS document_id, cast(doc_id % 6 AS int) AS page_num,
 concat(CASE (doc_id * 7) % 11 WHEN 0 THEN 'Sample ID and sample location first draw 3.21 ppb ' WHEN 1 THEN 'result 4.5 ' WHEN 2 THEN 'Chain of Custody relinquished by '
  WHEN 3 THEN 'Dear parent, we are writing to inform ' WHEN 4 THEN 'accreditation certification nelap ' WHEN 5 THEN 'APPENDIX A ' WHEN 6 THEN 'Page' WHEN 7 THEN '  '
  WHEN 8 THEN 'chain of custody flush sink ' ELSE '' END,
 CASE WHEN (doc_id * 7) % 11 IN (5, 6, 7) THEN '' ELSE coalesce(text, '') END) AS raw_text FROM {documents}""",
    "a5": """SELECT o_orderkey AS document_id, o_orderkey % 5 = 0 AS is_multi_school, o_orderkey % 10 <> 0 AS school_attribution_correct, round(0.5 + (o_orderkey % 6) / 10.0, 1) AS overall_confidence,
 cast(o_orderkey % 4 AS int) AS missed_count, cast(o_orderkey % 8 AS int) AS flagged_line_no FROM {orders}""",
    "a6": """SELECT o_orderkey AS document_id, concat('{{"school_name":', CASE WHEN o_orderkey % 4 = 0 THEN 'null' ELSE concat('"School ', cast(o_orderkey % 40 AS varchar(5)), '"') END,
 ',"measurements":[{{"sample_id":"S-', cast(o_orderkey AS varchar(20)), '","result_raw":"<1.00","result_ppb":1.0,"confidence":', CASE WHEN o_orderkey % 7 = 0 THEN '1.5' ELSE '0.9' END, '}}]}}') AS report_json FROM {orders}""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shape of the tables."""
    used = sorted(set(re.findall(r"(?<!\{)\{(\w+)\}", VIEWS[name])))
    return spark.sql(VIEWS[name], **{t: table(spark, sf_dir, t) for t in used})


def duck(*names: str) -> str:
    """The common table expressions of views, for DuckDB."""
    plain = {t: t for t in TABLES}
    return ", ".join(f"{n} AS ({VIEWS[n].format(**plain)})" for n in names)
