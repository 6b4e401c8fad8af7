"""Documents drawn by how much likelier a target corpus makes their word runs."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lodestat.llm.common import in_batches, utf8
from lodestat.session import settle_table

BUCKETS = 10_000
PIECE = 1 << 20
#: Word runs whose gain one task remembers.
REMEMBERED = 200_000
#: Letters A-Z become lower case; digits, letters and all bytes beyond ASCII stay; the rest separates.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_ROW_BITS = 33


def word_lists(body: bytes, longest: int) -> Iterator[tuple[list[bytes], int]]:
    """The words of a text, as lists of bounded size; the number says how many at a list's start were in the one before."""
    low, at, carried = body.translate(TABLE), 0, []
    while at < len(low):
        end = low.find(b" ", at + PIECE)
        end = len(low) if end < 0 else end
        words = carried + low[at:end].split()
        yield words, len(carried)
        carried, at = words[len(words) - longest + 1:] if longest > 1 else [], end


def features(words: list[bytes], known: int, longest: int) -> Iterator[int]:
    """CRC-32 of each run of at most ``longest`` words that ends behind the first ``known``, each run's from the one a word shorter."""
    crc = zlib.crc32
    for i, word in enumerate(words):
        seed = crc(word)
        if i >= known:
            yield seed
        for j in range(i + 1, min(i + longest, len(words))):
            seed = crc(words[j], crc(b" ", seed))
            if j >= known:
                yield seed


def bucket_counts(texts: DataFrame, text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many word runs of all rows fall into each bucket: one row per task and bucket moves, one per bucket returns."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for body in batch.column("body"):
                for words, known in word_lists(body.as_py(), longest):
                    if longest == 1:
                        found = Counter(words)
                        hashes, n = map(zlib.crc32, found), np.fromiter(found.values(), np.int64, len(found))
                    else:
                        found = Counter(features(words, known, longest))
                        hashes, n = found.keys(), np.fromiter(found.values(), np.int64, len(found))
                    np.add.at(total, np.fromiter(hashes, np.int64, len(found)) % buckets, n)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in texts.select(utf8(text).alias("body")).transform(in_batches, run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> list[int]:
    """Thousandths, rounded down, of the log-ratio of smoothed bucket shares, in doubles."""
    k, total_s, total_t = len(source), int(source.sum()), int(target.sum())
    return [math.floor(1000 * math.log((float(t) + 1) * (float(total_s) + k) / ((float(s) + 1) * (float(total_t) + k))))
            for s, t in zip(source.tolist(), target.tolist())]


def noise(seed: int, key) -> int:
    """Thousandths, rounded down, of Gumbel noise from a digest of the seed and the id; a null id is written as nothing."""
    h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


class _Gains(dict):
    """Gains of words, remembered up to a bound."""

    def __init__(self, table: list[int]):
        super().__init__()
        self.table = table

    def __missing__(self, word: bytes) -> int:
        value = self.table[zlib.crc32(word) % len(self.table)]
        if len(self) < REMEMBERED and len(word) <= 64:
            self[word] = value
        return value


def scored(docs: DataFrame, table: list[int], key: str = "doc_id", text: str = "text", seed: int = 2024, longest: int = 1) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row: its runs' summed gains, and that with noise."""
    def run(batches):
        known_gains = _Gains(table)
        for batch in batches:
            words_, n_, weights = [], [], []
            for body in batch.column("body"):
                words, n, weight = 0, 0, 0
                for part, known in word_lists(body.as_py(), longest):
                    words += len(part) - known
                    if longest == 1:
                        n += len(part)
                        weight += sum(map(known_gains.__getitem__, part))
                    else:
                        found = [table[h % len(table)] for h in features(part, known, longest)]
                        n += len(found)
                        weight += sum(found)
                words_.append(words)
                n_.append(n)
                weights.append(weight)
            scores = [w + noise(seed, k) for w, k in zip(weights, batch.column("doc_id").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (words_, n_, weights, scores))],
                                             names=["doc_id", "n_words", "n_features", "weight", "score"])

    slim = docs.select(F.col(key).alias("doc_id"), utf8(text).alias("body"))
    schema = T.StructType([slim.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight", "score"))])
    return slim.transform(in_batches, run, schema)


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", seed: int = 2024,
             longest: int = 1, buckets: int = BUCKETS, percent: int = 10, least_words: int = 20) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` for every row of ``docs``.

    Importance resampling without replacement: of the N rows with at least
    ``least_words`` words, the ``percent * N // 100`` highest scores are drawn and
    ranked, equal scores by the smaller id, null ids first, then by fewer features; rows
    equal in all that are in any order. The rest has a null rank. Ranks come from a
    range-sorted table: a row's number in its partition plus the rows of the
    partitions before. Null and empty texts have no words, weight 0 and noise only.
    Repeated rows stay; an empty target gives every bucket its smoothed share; an
    empty table gives no rows; other columns are not read.
    """
    table = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets))
    rows = settle_table(scored(docs, table, key, text, seed, longest))
    spark = docs.sparkSession
    order = [F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("n_features")]
    sorted_ = settle_table(rows.filter(F.col("n_words") >= least_words).repartitionByRange(*order).sortWithinPartitions(*order)
                           .withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", _ROW_BITS)
    sizes = sorted(sorted_.groupBy(part.alias("part")).count().collect())
    before, seen = [], 0
    for p, n in sizes:
        before.append((p, seen))
        seen += n
    drawn = percent * seen // 100
    starts = F.broadcast(spark.createDataFrame(before, "part bigint, before bigint"))  # a row for each partition
    place = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    ranked = sorted_.withColumn("part", part).join(starts, "part").select(*rows.columns, F.when(place <= drawn, place).alias("rank"))
    return ranked.unionByName(rows.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))


def draw(docs: DataFrame, target: DataFrame, key: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``docs`` whose ids are drawn, with all their columns; rows that share a drawn id all stay."""
    chosen = resample(docs, target, key, **settings).filter("rank is not null").select(F.col("doc_id").alias("drawn_id")).distinct().alias("chosen")
    return docs.alias("drawn_docs").join(chosen, F.col(f"drawn_docs.`{key}`").eqNullSafe(F.col("chosen.drawn_id")), "left_semi")
