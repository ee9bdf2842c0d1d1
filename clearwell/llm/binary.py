"""Operator 4, token-ID output: flat files of unsigned integers with 64-bit document offsets, read through memory maps."""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clearwell.llm import tokens
from clearwell.llm.common import documents, new_path, partitions, stored, values

RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _local(folder: str) -> str:
    if "://" in folder and not folder.startswith("file://"):
        raise ValueError("memory maps need a folder that is mounted on the driver and all executors; give one as folder")
    return folder.removeprefix("file://")


def _write(path: str, *parts: bytes) -> None:
    """All or nothing, and the same bytes again if the task is repeated."""
    with open(own := f"{path}.{os.getpid()}-{TaskContext.get().taskAttemptId()}", "wb") as f:
        for x in parts:
            f.write(x)
    os.replace(own, path)


def write(docs: DataFrame, folder: str, *, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """Writes the ids of docs by ascending doc_id (null first) and returns (shard, base, docs, tokens).

    Each shard has shard-N.bin, its ids as little-endian unsigned integers of 2 or 4 bytes; shard-N.off, 64-bit offsets of its
    documents within it, one more than documents; shard-N.doc, its 64-bit doc_ids; shard-N.nul, a byte 1 where the doc_id is null.
    format.json names the integer type. A shard's base, the ids of all shards before it, is the prefix sum of the shards' sizes.
    The text is dealt out by range of doc_id once and encoded where it lands, so ids are never shuffled. Null texts are end_id
    alone; rows that repeat a doc_id are each written; an empty table gives no shard.
    """
    path, local, spark = tokenizer or tokens.default_path(), _local(folder), docs.sparkSession
    kind = tokens.encoder(path).kind
    os.makedirs(local, exist_ok=True)
    with open(f"{local}/format.json", "w") as f:
        json.dump({"ids": kind.str, "offsets": "<i8", "end_id": end_id}, f)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, shard, own, held, sizes, ids = tokens.encoder(path), TaskContext.get().partitionId(), [], 0, [], []
        end = np.array([end_id], coder.kind).tobytes()
        os.makedirs(local, exist_ok=True)
        temporary = f"{local}/.shard-{shard}.{os.getpid()}-{TaskContext.get().taskAttemptId()}"
        with open(temporary, "wb") as f:
            for batch in batches:
                for doc_id, found in zip(batch.column(0).to_pylist(), coder.runs(values(batch.column(1))), strict=True):
                    own.append(x := found + end)
                    sizes.append(len(x) // coder.kind.itemsize)
                    ids.append(doc_id)
                    held += len(x)
                    if held > 1 << 22:
                        f.write(b"".join(own))
                        own, held = [], 0
            f.write(b"".join(own))
        if not sizes:
            os.remove(temporary)
            return
        os.replace(temporary, f"{local}/shard-{shard}.bin")
        _write(f"{local}/shard-{shard}.off", np.concatenate([[0], np.cumsum(sizes)]).astype("<i8").tobytes())
        _write(f"{local}/shard-{shard}.doc", np.array([x or 0 for x in ids], "<i8").tobytes())
        _write(f"{local}/shard-{shard}.nul", np.array([x is None for x in ids], np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([len(sizes)], pa.int64()), pa.array([sum(sizes)], pa.int64())], names=["shard", "docs", "tokens"])

    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id")
    shards = stored(dealt.mapInArrow(encode, "shard int, docs long, tokens long"), "shards")
    return shards.select("shard", (F.sum("tokens").over(Window.orderBy("shard")) - F.col("tokens")).alias("base"), "docs", "tokens")  # one row a shard


def read(shards: DataFrame, folder: str) -> DataFrame:
    """Each document of the shards with its global start, its number of ids and their crc32 as 32-bit integers; a shard is a task."""
    local, spark = _local(folder), shards.sparkSession
    with open(f"{local}/format.json") as f:
        kind = np.dtype(json.load(f)["ids"])
    rows = shards.select("shard", "base").collect()  # one row a shard

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at, name = np.fromfile(f"{local}/shard-{shard}.off", "<i8"), f"{local}/shard-{shard}"
                doc, null = np.fromfile(f"{name}.doc", "<i8"), np.fromfile(f"{name}.nul", np.uint8).astype(bool)
                ids = np.memmap(f"{name}.bin", kind, "r")
                crc = [zlib.crc32(ids[at[i] : at[i + 1]].astype("<u4").tobytes()) for i in range(len(doc))]
                yield pa.RecordBatch.from_arrays([pa.array(doc, mask=null), pa.array(at[:-1] + base), pa.array(np.diff(at)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    if not rows:
        return spark.createDataFrame([], RESULT)
    return spark.createDataFrame(rows, "shard int, base long").repartition(len(rows), "shard").mapInArrow(scan, RESULT)


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "ids")
    return read(write(documents(spark, sf_dir), folder), folder)
