"""Text expressions: white space, case, tokens, vocabularies."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from clearwell import fixed


def strip(c: Column) -> Column:
    """Without Unicode white space at either end; Spark's trim() takes blanks only."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


@lru_cache(1)
def _folds() -> tuple[str, str, list[tuple[str, str]]]:
    """Compatibility forms (NFKC) by rule: characters that become another single one, as two strings, and those that become several. Ideographs and Hangul stay."""
    one, many = [], []
    for i in range(0x80, 0x10000):
        c = chr(i)
        if unicodedata.category(c) not in ("Cs", "Cn", "Co") and not 0x3000 < i < 0xA000 and not 0xAC00 <= i < 0xD7A4 and not 0xF900 <= i < 0xFB00:
            folded = unicodedata.normalize("NFKC", c)
            if folded != c:
                (one if len(folded) == 1 else many).append((c, folded))
    return "".join(c for c, _ in one), "".join(f for _, f in one), [(c, f) for c, f in many if c in "ﬀﬁﬂﬃﬄﬅﬆ½¼¾⅓⅔…‥№℃℉™℠ĳŉ"]


def compatible(c: Column) -> Column:
    """Compatibility forms as their plain ones, for texts with a character outside ASCII: all that become a single character, and ligatures, fractions and signs that
    become several. Other expansions, and the composition of letters with separate marks, are left as they are."""
    before, after, several = _folds()
    out = F.translate(c, before, after)
    for x, plain in several:
        out = F.regexp_replace(out, F.lit(x), F.lit(plain))
    return F.when(c.rlike(r"[^\x00-\x7F]"), out).otherwise(c)


def normalize(c: Column) -> Column:
    """Compatibility forms as plain ones, micro signs as u, lower case, single blanks."""
    return strip(F.regexp_replace(F.lower(F.translate(compatible(c), "µμ", "uu")), r"(?U)\s+", " "))


def python_float(c: Column) -> Column:
    """A double as Python writes it: from 10**7 on without an exponent (whole numbers below 10**16), and small ones with a short one."""
    text = c.cast("string")
    small = F.concat(F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", ""), F.lit("e-"), F.lpad(F.substring_index(text, "E-", -1), 2, "0"))
    large = (F.abs(c) >= 1e7) & (F.abs(c) < 1e16) & (c == F.floor(c).cast("double"))
    plain = F.when(text.contains("E-"), F.when((F.abs(c) >= 1e-4), F.regexp_replace(F.format_string("%.12f", c), "0+$", "")).otherwise(small)).when(large, F.format_string("%.1f", c))
    return F.coalesce(plain, text, F.lit("None"))


def filled(c: Column) -> Column:
    """Null for an empty string."""
    return F.when(c != "", c)


def or_empty(*cs: Column) -> Column:
    """The first that is neither null nor empty; else an empty string."""
    return F.coalesce(*map(filled, cs), F.lit(""))


def title(c: Column) -> Column:
    """Capitals after everything that is not a letter, else lower case: Mary's gives Mary'S."""
    chars = F.split(F.lower(c), "")
    raised = F.transform(chars, lambda x, i: F.when((i == 0) | ~F.coalesce(F.get(chars, i - 1), F.lit("")).rlike(r"^\p{L}$"), F.upper(x)).otherwise(x))
    return F.array_join(raised, "")


def any_of(terms, *, words: bool = True, flags: str = "(?iU)") -> str:
    inner = f"(?:{'|'.join(terms)})"
    return f"{flags}\\b{inner}\\b" if words else flags + inner


def matches(c: Column, terms, **options) -> Column:
    return F.regexp_count(c, F.lit(any_of(terms, **options)))


def significant(c: Column) -> Column:
    """The lower-case tokens of two letters or digits and more that are not stopwords."""
    tokens = F.regexp_extract_all(F.lower(c), F.lit("([a-z0-9]+)"), F.lit(1))
    return F.filter(tokens, lambda t: (F.length(t) >= 2) & ~t.isin(*fixed.STOPWORDS))
