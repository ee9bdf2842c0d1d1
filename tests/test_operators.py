import os
import zipfile

import pytest
from pyspark.sql import functions as F

from clearwell.operators import files, lookup, pages, reports, schools, validation, verification
from clearwell.plans import agents, ingest
from clearwell.sinks import files as sinks
from clearwell.sources import files as sources
from clearwell.streaming import files as streaming


def test_scan_dedup_and_stream(spark, tmp_path):
    for name, content in {"b.pdf": "1", "a.PDF": "2", "c.pdf": "1", "d.Pdf": "3", "e.txt": "4"}.items():
        (tmp_path / name).write_text(content)
    found = files.first_of_content(files.scan(spark, str(tmp_path))).orderBy("scan_idx").collect()
    assert [(os.path.basename(r.path), r.outcome) for r in found] == [("b.pdf", "ingested"), ("c.pdf", "skipped"), ("a.PDF", "ingested")]
    assert files.scan(spark, str(tmp_path), 1).count() == 1
    streaming.catch_up(spark, str(tmp_path), f"{tmp_path}/out", f"{tmp_path}/check")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3


def test_failed_documents_block(spark):
    history = spark.createDataFrame([("x", "failed"), ("y", "ok")], "file_hash string, status string")
    new = spark.createDataFrame([("x",), ("y",), ("z",)], "file_hash string")
    assert files.unseen(new, history).count() == 1 and files.unseen(new, history, retry_failed=True).count() == 2


def test_gate_reasons(spark):
    rows = spark.createDataFrame(
        [("s1", "<1.0", "ug/L", 1.0, 0.9, "x <1.0 y"), (None, "ND", "ug/L", 3.0, 0.9, "ND here"), ("s3", "5", "gallons", 99.0, 0.5, "5"), ("s4", "5", None, 70000.0, None, None)],
        "sample_id string, result_raw string, unit_raw string, result_ppb double, confidence double, source_text string",
    ).withColumns({"sample_location": F.lit(None).cast("string"), "action_level_ppb": F.lit(15.0)})
    got = [r.reasons for r in validation.gate(rows).collect()]
    assert got == [[], ["no_locator"], ["no_source", "unit", "mismatch", "confidence"], ["no_source", "too_large", "mismatch"]]


def test_school_order_and_conflict(spark):
    rows = [("school 10", "wayne", 1), ("School 11", "Wayne", 2), ("PS #10", "WAYNE", 3), ("alpha high", None, 4), (None, "wayne", 5)]
    names = spark.createDataFrame(rows, "school_name string, district string, idx long")
    got = {r.school_name: (r.resolved_name, r.created) for r in schools.resolve(names).collect()}
    assert got == {"school 10": ("School 10", True), "School 11": ("School 10", False), "PS #10": ("School 10", False), "alpha high": ("Alpha High", True)}
    strict = {r.school_name: r.resolved_name for r in schools.resolve(names, number_conflict="strict").collect()}
    assert strict["School 11"] == "School 11" and strict["PS #10"] == "School 10"


def test_batches_and_agents():
    answers = {(1, 0, 1): {"report": {"school_name": "A", "measurements": [{"x": 1}]}, "tokens": 16_000}, (1, 2, 2): {"report": {"measurements": [{"x": 2}]}}, (1, 3, 3): {"report": {"school_name": "B", "lab_name": "L", "measurements": []}}}
    out = agents.extract(agents.Replay(answers), 1, [0, 1, 2, 3], 2)
    assert out["school_name"] == "A" and out["lab_name"] == "L" and [r["source_page"] for r in out["measurements"]] == [2, 3]
    split = agents.extract(agents.Replay({(1, 0, 0): {"report": {"measurements": [{"x": 1}]}}, (1, 1, 1): {"report": {"measurements": [{"x": 2}]}}}), 1, [0, 1], 2)
    assert [r["source_page"] for r in split["measurements"]] == [2, 2]


def test_reports_all_or_nothing(spark):
    good = '{"measurements":[{"result_ppb":1,"result_raw":"1","source_text":"abc","confidence":0.9,"analyte":" Copper "}]}'
    bad = good.replace("0.9", "1.9")
    parsed = reports.parse(spark.createDataFrame([(1, good), (2, bad), (3, "nonsense"), (4, None)], "document_id int, report_json string"))
    assert [r.document_id for r in parsed.where("valid and size(report.measurements) > 0").collect()] == [1]
    assert [r.analyte for r in reports.exploded(parsed).collect()] == ["copper"]


def test_lookup_sources_and_sinks(spark, tmp_path):
    header = "NCESSCH,LEAID,SCH_NAME,LEA_NAME,LSTREET1,LSTREET2,LCITY,LSTATE,LZIP\n"
    (tmp_path / "d.csv").write_text(header + '1,9,"School ""A"" 1",Wayne Boe,1 Main, ,Wayne, nj ,07000\n2,9,Other,Wayne,,,,PA,1\n')
    (tmp_path / "s.csv").write_text("x\n")
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.write(tmp_path / "d.csv", "d.csv")
        z.write(tmp_path / "s.csv", "s.csv")
    (tmp_path / "g.csv").write_text("NCESSCH,LAT,LON,STATE\n1,40.5,-74.5,NJ\n1,41.5,-74.25,NJ\n1,,1,NJ\n")
    directory = sources.directory(spark, sources.largest_member(f"{tmp_path}/z.zip", f"{tmp_path}/u"))
    lk = lookup.build(directory, sources.geocodes(spark, f"{tmp_path}/g.csv"))
    row = lk.first()
    assert lk.count() == 1 and (row.latitude, row.longitude, row.address) == (41.5, -74.25, "1 Main, Wayne, nj, 07000")
    path = sinks.lookup_csv(lk, f"{tmp_path}/lookup.csv")
    assert open(path, newline="").read() == 'nces_id,school_name,district_name,county,address,latitude,longitude\r\n1,"School ""A"" 1",Wayne Boe,,"1 Main, Wayne, nj, 07000",41.5,-74.25\r\n'
    assert sources.lookup(spark, path).count() == 1
    names = spark.createDataFrame([("PS 1", "Wayne"), ("PS 2", "Wayne"), (None, "Wayne"), ("x", None)], "school_name string, district string")
    assert [(r.school_name, r.nces_id) for r in lookup.match(names, lk).collect()] in ([("PS 1", "1")], [])
    with pytest.raises(RuntimeError):
        sources.directory(spark, f"{tmp_path}/s.csv")
    tally = lk.select("school_name").limit(0)
    assert sinks.unmatched_csv(tally, path) is None and not os.path.exists(path)


def test_verifier_null_flags_null(spark):
    rows = spark.createDataFrame([(1, None, 0.9), (1, "a", 0.9)], "document_id int, sample_id string, confidence double")
    found = spark.createDataFrame([(1, False, True, 1.0)], "document_id int, is_multi_school boolean, school_attribution_correct boolean, overall_confidence double")
    flagged = spark.createDataFrame([(1, None)], "document_id int, sample_id string")
    got = {r.sample_id: r.adjusted_confidence for r in verification.adjusted(rows, found, flagged).collect()}
    assert got == {None: 0.5, "a": 0.9}


def test_failed_pages_are_dropped(spark):
    f = spark.createDataFrame([("a", bytearray(b"x\fy")), ("b", bytearray(b"bad"))], "file_hash string, content binary")

    def reader(content):
        for part in content.decode().split("\f"):
            if part == "bad":
                raise ValueError("broken")
            yield part

    got = sorted(map(tuple, sources.extracted(f, reader).collect()), key=str)
    assert [(r[0], r[2]) for r in got] == [("a", "x"), ("a", "y"), ("b", None)]
    assert pages.classify(spark.createDataFrame([(0, "x"), (1, " ")], "page_num int, raw_text string")).where("is_blank").count() == 1


def test_agents_hear_what_the_batch_heard():
    class Scribe:
        def __init__(self, answers):
            self.answers, self.heard = answers, []

        def run(self, document_id, pages, context):
            self.heard.append((pages, context))
            return self.answers.get((pages[0], pages[-1]), {"report": {}, "truncated": True, "tokens": 0})

    row = {"x": 1}
    agent = Scribe({(0, 0): {"report": {"school_name": "A", "measurements": [row]}, "tokens": 10}, (1, 2): {"report": {"school_name": "B", "district": "D", "measurements": [row]}, "tokens": 14_000}, (3, 3): {"report": {"measurements": [row]}}, (4, 5): {"report": {"measurements": [row]}}})
    out = agents.extract(agent, 1, list(range(6)), 3)
    assert [p for p, _ in agent.heard] == [[0, 1, 2], [0], [1, 2], [3], [4, 5]]
    assert [c for _, c in agent.heard] == [{}, {}, {}, {"school_name": "A", "district": "D"}, {"school_name": "A", "district": "D"}]
    assert [r["source_page"] for r in out["measurements"]] == [3, 3, 4, 6] and out["tokens"] == 14_000


def test_sentences_of_reasons(spark):
    rows = spark.createDataFrame(
        [("s1", "Blue Wing", "5", "gallons", 99.0, 0.5, "5 ppb", 200.0), (None, None, "pending", None, 7e7, 0.9, None, None), ("", "", "1", None, -1.0, 0.9, "abc", 15.0)],
        "sample_id string, sample_location string, result_raw string, unit_raw string, result_ppb double, confidence double, source_text string, action_level_ppb double",
    )
    text = F.lit("the blue report 6")
    got = sorted(r.detail for r in validation.held_text(validation.gate(rows, text), text).collect())
    assert got == [
        "Row held by validation (s1): action_level_ppb 200.0 out of expected 1-100 range; unrecognized unit 'gallons'; result_ppb 99.0 disagrees with value derived from raw '5' (= 5.0); result_raw '5' not found anywhere in report; location 'Blue Wing' has words not in report: ['wing'] (possible hallucination); confidence 0.50 below threshold 0.70",
        "Row held by validation (unknown sample): row has neither sample_id nor sample_location; missing/too-short source_text (cannot verify provenance); result_ppb 70000000.0 exceeds sane max 50000 (likely a misread); could not derive a number from result_raw 'pending'; result_raw 'pending' not found anywhere in report",
        "Row held by validation (unknown sample): row has neither sample_id nor sample_location; result_ppb -1.0 is negative; result_ppb -1.0 disagrees with value derived from raw '1' (= 1.0); result_raw '1' not found anywhere in report",
    ]


def test_digest(spark):
    rows = [(1, 0, " first "), (1, 1, None), *[(1, i, "x" * 400) for i in range(2, 12)], (2, 0, " "), (3, 1, "only")]
    got = {r.document_id: r for r in pages.digest(spark.createDataFrame(rows, "document_id int, page_num int, raw_text string")).collect()}
    assert got[1].first_page == "first" and got[2].first_page == got[3].first_page == "(scanned — no text available)" and got[2].data_digest == "(no text pages)" and got[3].data_digest == "[Page 2] only"
    lines = got[1].data_digest.split("\n")
    assert lines[0] == "[Page 2: scanned image, no text]" and lines[1] == "[Page 3] " + "x" * 300 and lines[-1] == "... and 3 more pages" and len(lines) == 9
    assert sum(map(len, lines[:-2])) < 2000 <= sum(map(len, lines[:-1]))


def test_ingest_run(spark):
    text = "Sample ID s1 Blue Wing result 5 ppb lead in drinking water"
    docs = [(1, "/d/Essex County/Alden - 19-20 parsed/a.pdf", "h1", 1, False), (2, "/d/b.pdf", "h1", 2, False), (3, "/d/c.pdf", "h3", 3, False), (4, "/d/d.pdf", "h4", 4, True), (5, "/d/e.pdf", "h5", 5, False)]
    own = '{"sample_id":"s1","sample_location":"Blue Wing","result_ppb":5,"result_raw":"5","unit_raw":"ppb","source_text":"Blue Wing 5","confidence":%s%s}'
    answers = [(1, '{"school_name":"school 10","lab_name":" Lab ","measurements":[' + ",".join([own % ("0.9", ""), own % ("0.9", ',"school_name":"PS 10"'), own % ("0.3", "")]) + "]}"),
               (2, '{"measurements":[]}'), (3, '{"school_name":null,"measurements":[]}'), (5, '{"school_name":"Old","measurements":[' + (own % ("1.9", "")) + "]}")]
    found = spark.createDataFrame(
        [(1, False, "New School", True, None, False, True, 0.75, 2, [("s9", "odd")])],
        "document_id int, school_name_correct boolean, school_name_suggested string, district_correct boolean, district_suggested string, is_multi_school boolean, school_attribution_correct boolean, overall_confidence double, missed_count int, flagged_rows array<struct<sample_id:string,issue:string>>",
    )
    frames = spark.createDataFrame(docs, "document_id int, file_path string, file_hash string, scan_idx int, failed boolean"), spark.createDataFrame([(d, 0, text) for d in (1, 2, 3, 5)], "document_id int, page_num int, raw_text string"), spark.createDataFrame(answers, "document_id int, report_json string")
    run = ingest.ingest(*frames, found)
    assert sorted((r.resolved_name, r.district, r.confidence) for r in run.accepted.collect()) == [("New School", "Alden", 0.75), ("Ps 10", "Alden", 0.75)]
    assert sorted((r.document_id, r.issue_type, r.detail[:40]) for r in run.issues.collect()) == sorted([
        (1, "verification", "School name corrected: 'school 10' -> 'N"), (1, "verification", "Verifier overall confidence low (0.75); "), (1, "verification", "Verifier estimates 2 measurement(s) miss"), (1, "verification", "Flagged row s9: odd"),
        (1, "needs_review", "Row held by validation (s1): confidence "), (3, "no_school_found", "LLM did not return a school name."), (3, "no_measurements", "LLM returned no measurements for this re"), (5, "llm_error", "the answer does not match the schema"),
    ])
    assert {r.document_id: (r.outcome, r.status) for r in run.documents.collect()} == {1: ("ingested", "partial"), 2: ("skipped", None), 3: ("ingested", "failed"), 4: ("failed", None), 5: ("ingested", "failed")}
    assert run.counters.first() == (3, 1, 1, 5) and {r.lab_name for r in run.schools.collect()} == {"Lab"}


def test_matched_export_and_newest(spark, tmp_path):
    lk = spark.createDataFrame([("1", "Blue Wing School", "Alden Public Schools", "", "1 Main", 40.5, -74.0, 0), ("2", "School 4", "Other", "X", "", None, None, 1)], "nces_id string, school_name string, district_name string, county string, address string, latitude double, longitude double, rec_idx int")
    base = (None, "loc", None, None, None, 2020, 5.0, 0.9, 1, "f.pdf", "/d/Essex County/f.pdf")
    rows = spark.createDataFrame([("Blue Wing Elementary", "Alden Boe", *base), ("Nowhere", "Alden", *base), ("Nowhere", "Alden", *base), (None, None, *base)], "school_name string, district string, sample_id string, sample_location string, fixture_type string, draw_type string, sample_date date, test_year int, result_ppb double, confidence double, source_page int, file_name string, file_path string")
    exported, tally = reports.matched(rows, lk)
    got = sorted((r.school_name, r.county, r.coordinates, r.year) for r in exported.collect())
    assert got == [("", "Essex", "", "2020"), ("Blue Wing School", "Essex", "40.5, -74.0", "2020"), ("Nowhere", "Essex", "", "2020"), ("Nowhere", "Essex", "", "2020")]
    assert [tuple(r) for r in tally.collect()] == [("Nowhere", "Alden", 2, "f.pdf")]
    assert sinks.copy_newest(spark, f"{tmp_path}/none") is None
    sinks.export_csv(exported, str(tmp_path), "2020-01-01_000000")
    last = sinks.export_csv(exported.limit(1), str(tmp_path), "2020-01-02_000000")
    os.utime(last, (2e9, 2e9))
    assert sinks.newest(spark, str(tmp_path)) == ["export_2020-01-02_000000.csv", "export_2020-01-01_000000.csv"]
    assert open(sinks.copy_newest(spark, str(tmp_path))).read() == open(last).read() and "coordinates" in open(last).readline()


def test_blocks_lose_no_pair(spark):
    import itertools
    import random

    from clearwell.functions.fuzzy import set_ratio

    rng = random.Random(1)
    names = {"abxcdef", "abcdyef", "abcdef", "abxcdyef", *("".join(rng.choice("ab c") for _ in range(rng.randrange(3, 13))).strip() for _ in range(60))} - {""}
    names = sorted({" ".join(x.split()) for x in names} - {""})
    df = spark.createDataFrame([(x,) for x in names], "d string")
    got = {tuple(r) for r in lookup._blocks(df, df.withColumnRenamed("d", "cd")).collect()}
    assert got == {(a, b) for a, b in itertools.product(names, names) if set_ratio(a, b) >= 85}
