"""Exact duplicates through content-defined chunk recipes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from lodestat.llm.common import in_batches, row_key, slabs, utf8, with_decision
from lodestat.session import settle_table

WINDOW = 32
MIN_CHUNK, MAX_CHUNK, MASK_BITS = 512, 16_384, 11
_GEAR = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 32, 256, dtype=np.uint32)
_PIECE = 1 << 20
_CHUNK = T.StructType([T.StructField("fp", T.LongType()), T.StructField("digest", T.BinaryType())])


def _rolling(data: np.ndarray) -> np.ndarray:
    """At each byte, a hash of the last 32 bytes up to it, by doubling the window."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8, 16):
        older = np.zeros_like(h)
        older[step:] = h[:-step] << np.uint32(step)
        h = h + older
    return h


def cuts(body: bytes) -> list[int]:
    """End offsets of the chunks of one text; they depend on its content alone."""
    n = len(body)
    if n <= MIN_CHUNK:
        return [n] if n else []
    data = np.frombuffer(body, np.uint8)
    mask, found = np.uint32((1 << MASK_BITS) - 1), []
    for start in range(0, n, _PIECE):
        back = max(0, start - WINDOW)
        hit = np.flatnonzero((_rolling(data[back:start + _PIECE]) >> np.uint32(32 - MASK_BITS) & mask) == 0) + back
        found.append(hit[hit >= start])
    ends, last = [], 0
    for at in (np.concatenate(found) + 1).tolist():
        while at - last > MAX_CHUNK:
            last += MAX_CHUNK
            ends.append(last)
        if at - last >= MIN_CHUNK:
            last = at
            ends.append(at)
    while n - last > MAX_CHUNK:
        last += MAX_CHUNK
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def _recipes(fp_bits: int):
    mask = (1 << fp_bits) - 1
    chunk = pa.list_(pa.struct([("fp", pa.int64()), ("digest", pa.binary())]))

    def run(batches):
        for batch in batches:
            made = []
            for _, bodies in slabs(batch.column("body")):
                for body in bodies:
                    last, parts = 0, []
                    for end in cuts(body):
                        piece = body[last:end]
                        fp = xxhash.xxh3_64_intdigest(piece) & mask
                        parts.append({"fp": fp - (1 << 64) if fp >> 63 else fp, "digest": hashlib.sha256(piece).digest()})
                        last = end
                    made.append(parts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("k_id"), batch.column("k_sha"), pa.array(made, chunk)], names=["k_id", "k_sha", "chunks"])
    return run


def _identified(recipes: DataFrame) -> DataFrame:
    """Add ``ids``: the ordered verified identifiers of a text's chunks.

    The dictionary holds every (fingerprint, SHA-256) pair once. A fingerprint with
    one digest is itself the identifier; where two digests share a fingerprint, the
    chunks are told apart by their digest's rank.
    """
    seen = recipes.select(F.explode("chunks").alias("c")).select("c.fp", "c.digest").distinct()
    clashing = seen.groupBy("fp").agg(F.count("*").alias("n")).filter("n > 1").select("fp")
    ranked = settle_table(seen.join(clashing, "fp", "left_semi").withColumn(
        "rank", F.row_number().over(Window.partitionBy("fp").orderBy("digest"))))
    plain = recipes.withColumn("ids", F.transform("chunks", lambda c: F.struct(c["fp"].alias("fp"), F.lit(1).alias("rank"))))
    if ranked.isEmpty():
        return plain.drop("chunks")
    told = (recipes.select("rid", F.posexplode("chunks").alias("at", "c")).select("rid", "at", "c.fp", "c.digest")
            .join(ranked, ["fp", "digest"], "left")
            .groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("at", "fp", F.coalesce("rank", F.lit(1)).alias("rank")))).alias("o"))
            .select("rid", F.transform("o", lambda c: F.struct(c["fp"].alias("fp"), c["rank"].alias("rank"))).alias("told")))
    return plain.join(told, "rid", "left").withColumn("ids", F.coalesce("told", "ids")).drop("chunks", "told")


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", fp_bits: int = 64) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes are; null counts as empty, and empty texts form
    one group. Of equal texts the row with the largest id stays; a null id is smaller
    than any other, and of fully repeated rows exactly one stays. An empty table gives
    no rows. Other columns are not read. Long texts move once, as recipes of about two
    per cent of their size; ``fp_bits`` is for tests of colliding fingerprints.
    """
    keyed = row_key(docs, key, text)
    schema = keyed.select("k_id", "k_sha").schema.add("chunks", T.ArrayType(_CHUNK))
    recipes = settle_table(keyed.transform(in_batches, _recipes(fp_bits), schema).withColumn("rid", F.monotonically_increasing_id()))
    ids = _identified(recipes)
    # The lists are compared themselves; the hash only makes the join keys short.
    ids = settle_table(ids.withColumn("h", F.xxhash64("ids")))
    groups = ids.groupBy("h", "ids").agg(
        F.max(F.struct("k_id", "rid")).alias("top"), F.count("*").alias("group_size"))
    return ids.join(groups, ["h", "ids"]).select(
        F.col("k_id").alias("doc_id"), F.col("top.k_id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("top.rid")).alias("kept"), F.col("k_sha").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_duplicates`` drops; all its columns stay.

    Of rows with one id and one text, whatever their other columns, one stays.
    """
    found = settle_table(exact_duplicates(docs, key, text))
    rows = settle_table(found.groupBy(F.col("doc_id").alias("k_id"), F.col("text_sha256").alias("k_sha"))
                        .agg(F.count("*").alias("n"), F.max("kept").alias("stays")))
    stay = with_decision(docs, rows.filter("not stays"), "left_anti", key, text)
    repeated = rows.filter("stays and n > 1")
    if repeated.isEmpty():
        return stay
    tag = "_".join([*docs.columns, "sha"])  # a name that no column has
    once = (with_decision(stay, repeated, "left_semi", key, text).withColumn(tag, F.sha2(utf8(text), 256))
            .dropDuplicates([key, tag]).drop(tag))
    return with_decision(stay, repeated, "left_anti", key, text).unionByName(once)
