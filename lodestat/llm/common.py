"""Helpers shared by the text operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodestat.operators.sizing import broadcast_checked

SLAB_BYTES = 2 << 20
BATCH_BYTES = 8 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: str = "text") -> Column:
    """The bytes of a text; a null counts as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def row_key(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(k_id, k_sha, body)``: a row's id, the digest of its text, and the bytes of the text.

    The two key columns tell apart rows that share an id but not their text; fully
    repeated rows have the same key, and so get the same decision.
    """
    return df.select(F.col(key).alias("k_id"), F.sha2(utf8(text), 256).alias("k_sha"), utf8(text).alias("body"))


def with_decision(docs: DataFrame, decisions: DataFrame, how: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Semi or anti join of ``docs`` to ``(k_id, k_sha)`` rows; every column of ``docs`` stays.

    The decisions are broadcast only if measured to be small.
    """
    wanted = broadcast_checked(decisions.select("k_id", "k_sha").distinct()).alias("wanted")
    same = F.col("wanted.k_id").eqNullSafe(F.col(f"kept_docs.`{key}`")) & (
        F.col("wanted.k_sha") == F.sha2(F.coalesce(F.col(f"kept_docs.`{text}`").cast("binary"), F.lit(b"")), 256))
    return docs.alias("kept_docs").join(wanted, same, how)


def giving_back(run):
    """``run``, then Arrow's freed memory goes back, which a worker process would else keep through later stages."""
    def rows(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
    return rows


def in_batches(df: DataFrame, run, schema, size: int = BATCH_BYTES) -> DataFrame:
    """``mapInArrow`` in batches of bounded bytes, since rows may hold long texts."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    df.sparkSession.conf.set(name, str(size))
    return df.mapInArrow(giving_back(run), schema)


def slabs(column: pa.Array, limit: int = SLAB_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of neighbouring values of a binary column with about ``limit`` bytes each, with the first row's number."""
    first, held, size = 0, [], 0
    for i, value in enumerate(column):
        body = value.as_py()
        held.append(body)
        size += len(body)
        if size >= limit:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound and computed again beyond it."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.most:
            self[word] = value
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
