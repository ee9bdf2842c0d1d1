"""Word lists, limits and formats that results depend on."""

# Result values: forms of a non-detect, the number after a less-than sign, the first number.
NON_DETECT = r"(?:^|\b)(?:nd|bdl|non[-\s]?detect(?:ed)?|not\s+detected|none\s+detected|<\s*(?:mdl|rl|loq))\b"
LESS_THAN, PLAIN_NUMBER = r"<\s*(\d+(?:\.\d+)?)", r"(\d+(?:\.\d+)?)"

# Units, in lower case after normalization.
PPB_UNITS = ("ug/l", "µg/l", "ppb", "ppb (ug/l)", "ug/l (ppb)")
SCALED_UNITS = {"mg/l": 1000.0, "ppm": 1000.0}
MISREAD_UNITS = ("pg/l", "yg/l", "g/l", "ng/l", "hg/l", "yo/l", "ygil", "po/l", "pgil")

# Limits of the validation gate.
LEAST_PPB, MOST_PPB = 0.0, 50_000.0
ACTION_LEVELS = (1.0, 100.0)
NON_DETECT_MOST = 5.0
TOLERANCE = 0.51
LEAST_CONFIDENCE = 0.70
SHORTEST_SOURCE, SHORTEST_REPORT = 3, 30

# The sentences of the gate's reasons; names in braces are the row's values.
REASONS = {
    "no_locator": "row has neither sample_id nor sample_location",
    "no_source": "missing/too-short source_text (cannot verify provenance)",
    "negative": "result_ppb {result} is negative",
    "too_large": "result_ppb {result} exceeds sane max {most} (likely a misread)",
    "action_level": "action_level_ppb {level} out of expected 1-100 range",
    "unit": "unrecognized unit '{unit}'",
    "no_number": "could not derive a number from result_raw '{raw}'",
    "mismatch": "result_ppb {result} disagrees with value derived from raw '{raw}' (= {derived})",
    "value_not_in_text": "result_raw '{raw}' not found anywhere in report",
    "place_not_in_text": "location '{place}' has words not in report: {missing} (possible hallucination)",
    "confidence": "confidence {confidence} below threshold {least}",
}

# Words of a location that need no evidence.
STOPWORDS = ("the", "of", "a", "an", "and", "or", "in", "on", "at", "by", "for", "to", "with", "from", "no")

# Page vocabularies.
DATA_TERMS = (
    "ppb", "ug/l", "µg/l", "mg/l", "ppm", r"result", r"lead\s+concentration", r"action\s+level", r"sample\s+id", r"sample\s+location",
    r"sample\s+point", "fixture", r"first\s+draw", "flush", "faucet", "fountain", r"water\s+cooler", "bubbler", "non[- ]?detect", r"nd\b",
    "outlet", "spigot", "sink", "tap",
)
CUSTODY_TERMS = (
    r"chain\s+of\s+custody", r"sample\s+receipt", r"relinquished\s+by", r"received\s+by", r"sample\s+login", r"cooler\s+temp",
    r"custody\s+record", r"coc\s+number", r"coc\s+#",
)
LETTER_TERMS = (
    r"^dear\s", "sincerely", r"we\s+are\s+writing", r"pleased\s+to\s+inform", r"to\s+whom\s+it\s+may\s+concern",
    r"enclosed\s+(?:please\s+find|are)", r"attached\s+(?:please\s+find|are)",
)
LABORATORY_TERMS = (
    "accreditation", "certification", "nelap", "nelac", r"iso\s+17025", r"this\s+report\s+shall\s+not", r"unless\s+otherwise\s+noted",
    r"quality\s+assurance", r"analytical\s+methods?\s+summary",
)
DIVIDER_TERMS = ("attachment", "appendix", r"table\s+of\s+contents")

# Names of schools and districts.
SCHOOL_SUFFIXES = r"e\.?s\.?|m\.?s\.?|h\.?s\.?|jr\.?|sr\.?"
SCHOOL_FILLERS = ("school", "elementary", "middle", "high", "academy", "center", "complex", "public", "charter", "the", "and")
DISTRICT_WORDS = {
    "boe": "board of education", "wpboe": "woodland park board of education", "mua": "municipal utilities authority", "twp": "township",
    "boro": "borough", "bd": "board", "ed": "education",
}
DISTRICT_NOISE = (
    r"board\s+of\s+education", r"municipal\s+utilities?\s+authority", r"public\s+school\s+district", r"public\s+schools?",
    r"school\s+district", r"school\s+system", "schools?", "district", "regional",
)
NUMBERED = (r"\bp\.?\s*s\.?\s*#?\s*(\d{1,3})\b", r"\bschool\s*(?:no\.?\s*)?#?\s*(\d{1,3})\b", r"#\s*(\d{1,3})\b")
DISTRICT_SCORE, NAME_SCORE, NUMBERED_SCORE, INGEST_SCORE = 85.0, 82.0, 40.0, 88.0
LABORATORIES = ("emsl", "lew", "ramm", "apl", "pas", "rk", "whitman", "york", "new wave", "deblock-apl", "deblock")
FOLDER_SUFFIX = r"(?i)\s*[-–]\s*(\d{2,4}[-–]\d{2,4}\s*parsed|fully\s*parsed|parsed)"

# The verifier's rules.
FEW_PAGES, SURE_CONFIDENCE, FEW_ROWS = 6, 0.85, 50
DOUBTED, TRUSTED_OVERALL = 0.5, 0.8
NAME_LENGTHS = (2, 60)
# Batches of pages.
TEXT_PAGES, IMAGE_PAGES, BATCH_PAGES = 12, 4, 2
MOST_TOKENS, NEAR_CAP = 16_384, 0.85
# A digest of pages: characters of the first page, of each other, and of these in all; and what it says of pages without text.
FIRST_SNIPPET, PAGE_SNIPPET, DIGEST = 800, 300, 2000
NO_FIRST_TEXT, NO_PAGES = "(scanned — no text available)", "(no text pages)"
ONE_SCHOOL = "(all under report-level school)"

EXPORT_COLUMNS = (
    "county", "district", "school_name", "address", "coordinates", "sample_id", "sample_location", "fixture_type", "draw_type",
    "sample_date", "year", "lead_concentration_ppb", "confidence", "source_page", "source_file",
)
LOOKUP_COLUMNS = ("nces_id", "school_name", "district_name", "county", "address", "latitude", "longitude")
