"""Calls to extraction agents: an interface, answers replayed from records, batches run in order with halving."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearwell import fixed


class Agent(Protocol):
    def run(self, document_id: int, pages: list[int], context: dict) -> dict:
        """{"report": {...}, "truncated": bool, "tokens": int} for pages; context: the header fields found so far."""


class Replay:
    """Answers from records: {(document_id, first page, last page): answer}; one that is missing is a truncated, empty answer."""

    def __init__(self, records: dict[tuple[int, int, int], dict]):
        self.records = records

    def run(self, document_id: int, pages: list[int], context: dict) -> dict:
        return self.records.get((document_id, pages[0], pages[-1]), {"report": {}, "truncated": True, "tokens": 0})


HEADER = ("school_name", "district", "lab_name")


def _ask(agent: Agent, document_id: int, pages: list[int], context: dict) -> tuple[dict, int]:
    """The report of a batch and its tokens. One that is truncated and empty is asked again in halves, the smaller first; both hear what the whole heard,
    and the larger number of tokens counts."""
    answer = agent.run(document_id, pages, context)
    report = answer.get("report") or {}
    if not answer.get("truncated") or report.get("measurements") or len(pages) < 2:
        return report, answer.get("tokens", 0)
    cut = len(pages) // 2
    (one, first), (two, second) = (_ask(agent, document_id, part, context) for part in (pages[:cut], pages[cut:]))
    both = {k: one.get(k) or two.get(k) for k in HEADER}
    return both | {"measurements": [*(one.get("measurements") or []), *(two.get("measurements") or [])]}, max(first, second)


def extract(agent: Agent, document_id: int, pages: list[int], size: int, most_tokens: int = fixed.MOST_TOKENS) -> dict:
    """One report of a document's pages, with the tokens of all batches as tokens.

    Batches of size pages go in order; each hears the header found before. One that used 85 percent of the tokens halves the batch after it.
    source_page of a row is the last page of its batch as it was planned, from 1, also where the batch was asked in halves.
    """
    out: dict = {**dict.fromkeys(HEADER), "measurements": [], "tokens": 0}
    waiting = [pages[i : i + size] for i in range(0, len(pages), size)]
    while waiting:
        own = waiting.pop(0)
        report, used = _ask(agent, document_id, own, {k: out[k] for k in HEADER if out[k]})
        for k in HEADER:
            out[k] = out[k] or report.get(k)
        out["measurements"] += [{**r, "source_page": max(own) + 1} for r in report.get("measurements") or []]
        out["tokens"] += used
        if waiting and used >= int(fixed.NEAR_CAP * most_tokens) and len(waiting[0]) > 1:
            cut = len(waiting[0]) // 2
            waiting[:1] = [waiting[0][:cut], waiting[0][cut:]]
    return out


def reports(batches: DataFrame, agent: Agent) -> DataFrame:
    """batches (document_id, page_nums array<int>, batch_pages int) to (document_id, report_json); a document is one row, its batches run in its task."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pd.DataFrame({"document_id": pdf["document_id"], "report_json": [json.dumps(extract(agent, int(d), [int(p) for p in ps], int(n))) for d, ps, n in zip(pdf["document_id"], pdf["page_nums"], pdf["batch_pages"], strict=True)]})

    return batches.select(F.col("document_id").cast("long").alias("document_id"), "page_nums", "batch_pages").mapInPandas(run, "document_id long, report_json string")


def planned(kept: DataFrame) -> DataFrame:
    """The input of reports() for kept pages (document_id, page_num, is_blank): their numbers in order, and the pages of a batch."""
    per = kept.groupBy("document_id").agg(F.sort_array(F.collect_list("page_num")).alias("page_nums"), F.count("*").alias("n"), F.count_if("is_blank").alias("images"))
    one = F.when(F.col("images") > 0, F.col("images") <= fixed.IMAGE_PAGES).otherwise(F.col("n") <= fixed.TEXT_PAGES)
    return per.select("document_id", "page_nums", F.when(one, F.col("n")).otherwise(fixed.BATCH_PAGES).cast("int").alias("batch_pages"))
