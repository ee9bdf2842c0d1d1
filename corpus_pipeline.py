"""Documents to packed sequences: language ID, near duplicates, secrets, mixing, packing.

Every stage takes null values in any column, empty and very long texts, ties, rows that repeat and an empty table (which gives an empty table), and
keeps columns of its own input whose names are those of its operator's results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearwell.llm import jaccard, language, mixing, packing, secrets
from clearwell.llm.common import documents, drop, let_go, stored

#: A document whose likeliest language has a lower posterior probability goes, as does one without letters.
LEAST_SCORE = 0.5


def beside(docs: DataFrame, results: tuple[str, ...], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of stage(docs) with the columns of docs; those that are called like one of the results step aside meanwhile."""
    aside = {c: f"_own_{i}" for i, c in enumerate(docs.columns) if c.lower() in results}
    out = stage(docs.withColumnsRenamed(aside))
    return out.select(*(F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found with a score of LEAST_SCORE; those without a letter, null and empty texts go. Equal texts fare alike."""
    model = language.train(docs)
    return beside(docs, ("lang_pred", "score"), lambda d: language.identify(d, model).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the document of the smallest doc_id stays, with all rows of that doc_id; rows without a doc_id all stay, as nothing names them."""
    first = jaccard.join(docs).where("doc_id = component_id").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(first, "doc_id", "left_semi")
    return named.unionByName(docs.where("doc_id is null")).select(docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span that the scan finds is replaced by a mark; n_chars follows. All rows stay; null texts stay null."""
    found = secrets.redact(docs, secrets.train(docs))
    return found.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each use of a document, in the order of training; documents that the mix does not take, as those without a word, go."""
    results = ("size", "source_size", "target", "taken", "positions", "position", "_at", "_bucket", "_b", "_before", "_start", "_uses", "_source", "_s", "_n", "slope")
    return beside(docs, results, lambda d: mixing.ordered(mixing.mix(d)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every row with their places in sequences; a null text is its end id alone. Remembers fewer pieces than the query alone: the workers
    share memory with what earlier stages have left to the executor."""
    let_go()
    return packing.pack(docs, known=200_000)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The models, the tokenizer and the packing have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. The table of a stage goes when the next one's is written; the last one's result reads only tables of its own."""
    docs, before = documents(spark, sf_dir), None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name)
        if before is not None:
            drop(before)
        before = docs
    return docs
