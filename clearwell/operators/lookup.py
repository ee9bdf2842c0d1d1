"""The reference dimension: directory and geocodes to one lookup, and its fuzzy match."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clearwell import fixed
from clearwell.functions.fuzzy import set_score, weighted_score
from clearwell.functions.names import address, coordinates, normal_district, normal_school, school_number


def in_state(directory: DataFrame, state: str = "NJ", column: str = "LSTATE") -> DataFrame:
    return directory.where(F.upper(F.trim(column)) == state)


def usable_geocodes(geocodes: DataFrame, state: str = "NJ") -> DataFrame:
    own = "STATE" if "STATE" in geocodes.columns else "LSTATE"
    return in_state(geocodes, state, own).where("trim(NCESSCH) <> '' and LAT is not null and LON is not null")


def _both(own: str, other: str):
    """A coordinate as a number, unless either is none."""
    x, y = (F.col(f"g.{c}").try_cast("double") for c in (own, other))
    return F.when(x.isNotNull() & y.isNotNull(), x)


def kept_counts(directory: DataFrame, geocodes: DataFrame, state: str = "NJ") -> DataFrame:
    """One row: the rows of either source, those kept for the state, and the directory's that have a geocode."""
    geo = usable_geocodes(geocodes, state)
    ids = geo.select(F.trim("NCESSCH").alias("_k")).distinct()
    own = in_state(directory, state)
    found = own.select(F.trim("NCESSCH").alias("_k")).join(ids, "_k", "left_semi")
    one = lambda df, name: df.agg(F.count("*").alias(name))
    parts = [one(directory, "directory_rows"), one(own, "directory_kept"), one(geocodes, "geocode_rows"), one(geo, "geocode_kept"), one(found, "joined")]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)  # one row each
    return out


def build(directory: DataFrame, geocodes: DataFrame, state: str = "NJ") -> DataFrame:
    """The seven columns of the lookup and rec_idx: directory rows of the state with the last geocode of their id, if any."""
    last = usable_geocodes(geocodes, state).groupBy(F.trim("NCESSCH").alias("_k")).agg(F.max_by(F.struct("LAT", "LON"), "file_row").alias("g"))
    d = in_state(directory, state).withColumn("_k", F.trim("NCESSCH")).join(last, "_k", "left")
    where = address(*(F.col(c) for c in ("LSTREET1", "LSTREET2", "LCITY", "LSTATE", "LZIP")))
    county = F.trim(F.col("NMCNTY")) if "NMCNTY" in directory.columns else F.lit("")
    return d.select(F.col("_k").alias("nces_id"), F.trim("SCH_NAME").alias("school_name"), F.trim("LEA_NAME").alias("district_name"), county.alias("county"),
                    where.alias("address"), _both("LAT", "LON").alias("latitude"), _both("LON", "LAT").alias("longitude"), "rec_idx")


def identity(pairs: DataFrame) -> DataFrame:
    """Of (key, number, cand_number): a numbered name keeps candidates of its number, or, if it has none, unnumbered ones; others keep unnumbered ones."""
    same = F.coalesce(F.col("number") == F.col("cand_number"), F.lit(False))
    p = pairs.withColumn("same_number", same).withColumn("_some", F.max("same_number").over(Window.partitionBy("key")))
    return p.where(F.when(F.col("_some"), F.col("same_number")).otherwise(F.col("cand_number").isNull())).drop("_some")


def _blocks(own: DataFrame, known: DataFrame) -> DataFrame:
    """(d, cd): pairs of distinct district names with a set score of DISTRICT_SCORE.

    Names that score so share a word, or their words in order are strings with 85 percent of their letters in common: then one has at most 0.15 of the letters
    left out and the other as many put in, and of the pieces between, one is three letters long, or two where neither name has over eight. So pairs meet by a
    word, by three letters, or short ones by two, and are scored once each.
    """
    whole = lambda c: F.array_join(F.array_sort(F.array_distinct(F.split(c, " "))), " ")
    runs = lambda s, k: F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - k + 1, F.lit(1))), lambda i: F.substring(s, i, F.lit(k)))
    marks = lambda c: F.array_union(F.array_union(F.split(c, " "), runs(whole(c), 3)), F.when(F.length(whole(c)) <= 8, runs(whole(c), 2)).otherwise(F.array().cast("array<string>")))
    a = own.select("d", F.explode(marks(F.col("d"))).alias("mark"))
    b = known.select("cd", F.explode(marks(F.col("cd"))).alias("mark"))
    return a.join(b, "mark").select("d", "cd").distinct().where(set_score("d", "cd") >= fixed.DISTRICT_SCORE)


def match(names: DataFrame, lookup: DataFrame) -> DataFrame:
    """Each distinct (school_name, district) of names with its best lookup row, if one scores enough.

    Districts are scored on their distinct normal forms; schools then meet the lookup by equality of the district's block. Of the
    candidates that identity() leaves, the best weighted score wins, the first row on a tie.
    """
    keys = names.select("school_name", "district").distinct().where("school_name is not null and school_name <> ''")
    keys = keys.withColumn("d", normal_district(F.col("district"))).where("d <> ''").withColumn("n", normal_school(F.col("school_name"))).withColumn("number", school_number(F.col("school_name")))
    keys = keys.withColumn("key", F.xxhash64("school_name", "district"))
    rows = lookup.withColumn("cd", normal_district(F.col("district_name"))).withColumn("cn", normal_school(F.col("school_name"))).withColumn("cand_number", school_number(F.col("school_name")))
    # distinct district names meet by a shared word: without one, the set score is that of the whole strings; only such pairs meet by their letters
    blocks = _blocks(keys.select("d").distinct(), rows.where("cd <> ''").select("cd").distinct())
    candidates = rows.select("cd", "cn", "cand_number", "rec_idx", F.struct("nces_id", F.col("school_name").alias("name"), "district_name", "county", "address", "latitude", "longitude").alias("found"))
    pairs = identity(keys.join(blocks, "d").join(candidates, "cd")).withColumn("score", weighted_score("n", "cn"))
    best = pairs.groupBy("school_name", "district").agg(F.max_by(F.struct("score", "same_number", "rec_idx", "found"), F.struct("score", -F.col("rec_idx"))).alias("m"))
    return best.where(F.expr(f"m.score >= {fixed.NAME_SCORE} or (m.same_number and m.score >= {fixed.NUMBERED_SCORE})")).select("school_name", "district", F.col("m.score").alias("score"), "m.rec_idx", "m.found.*")


__all__ = ["build", "coordinates", "identity", "in_state", "match", "usable_geocodes"]
