import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clearwell.functions import fuzzy, names, text, values


def column(spark, f, inputs):
    rows = spark.createDataFrame(list(enumerate(inputs)), "i int, x string").select("i", f(F.col("x")).alias("y")).orderBy("i").collect()
    return [r.y for r in rows]


CASES = {
    "separated": (values.separated, {"2,260": "2260", "4,76": "4.76", "1,234,567": "1234,567", "1,2,3": "1.2,3"}),
    "non_detect": (values.is_non_detect, {"ND": True, "<MDL": True, "< RL": True, "None Detected": True, "NON-DETECTED": True, " <MDL": False, "2ND": False, "<0.5": False, "n.d.": False, "NDs": False, None: False}),
    "title": (text.title, {"P.S. #10": "P.S. #10", "o'neil st. mary's": "O'Neil St. Mary'S", "McKINLEY 2nd": "Mckinley 2Nd", "excel-bldg": "Excel-Bldg", None: None}),
    "strip": (text.strip, {"  a b\t\n": "a b", "": ""}),
    "number": (names.school_number, {"PS#10": 10, "Ps 28": 28, "Public School #4": 4, "School #6/Middle School": 6, "Charles J. Riley/School 9": 9, "John F. Kennedy High": None, "Building 42": None, "PS No. 10": None}),
    "district": (names.normal_district, {"Wayne Township Board Of Education": "wayne township", "Ringwood Boe": "ringwood", "Paterson Public Schools": "paterson", "Wpboe": "woodland park", "Ringwood Boe #9041": "ringwood", None: ""}),
    "county": (names.county, {"/data/Passaic County/x.pdf": "Passaic", "/d/A county/B County/x": "A", "/d/X COUNTY/y": "X COUNTY", "/d/x": ""}),
    "unit": (values.unit_kind, {"ug/L": "ppb", "µg/L.": "ppb", "mg/L": "scaled", "pg/l": "misread", " ; ": "none", None: "none", "gallons": "unknown"}),
}


@pytest.mark.parametrize("name", CASES)
def test_vectors(spark, name):
    f, cases = CASES[name]
    assert column(spark, f, list(cases)) == list(cases.values())


def test_derived(spark):
    rows = [("ND", "ug/L", 0.0), ("<1.00", None, 1.0), ("0.005", "mg/L", 5.0), ("0.005", "mg/L.", 0.005), ("2,260", "ppb", 2260.0), ("pending", "ppb", None), (None, None, None)]
    got = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(rows)], "i int, a string, b string").select("i", values.derived_ppb(F.col("a"), F.col("b")).alias("y")).orderBy("i").collect()
    assert [r.y for r in got] == [c for _, _, c in rows]


def test_anchors():
    assert round(fuzzy.ratio("dale ave", "dale avenue"), 2) == 84.21
    assert fuzzy.set_ratio("paterson district", "verona district") == 81.25
    assert round(fuzzy.ratio("School 10", "School 11"), 2) == 88.89


words = st.text("abc ", max_size=12)


@settings(max_examples=200, deadline=None)
@given(words, words)
def test_similarity_laws(a, b):
    for f in (fuzzy.ratio, fuzzy.set_ratio, fuzzy.sort_ratio, fuzzy.weighted):
        assert 0 <= f(a, b) <= 100 and abs(f(a, b) - f(b, a)) < 1e-9
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert fuzzy.common(a, b) == table[-1][-1]
