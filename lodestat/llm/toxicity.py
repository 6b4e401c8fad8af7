"""Toxic passages: maximum-scoring segments over token log-odds."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lodestat.llm.common import in_batches, utf8
from lodestat.session import settle_table

#: Labelled rows to learn from, by a hash of the id; the only sample here.
MAX_LABELLED = 200_000
#: Terms whose contexts are counted, and entries of the lexicon, as bounds on what a model of a bounded sample
#: may hold; the most significant stay. Both are parameters of ``learn``.
MAX_CANDIDATES, MAX_LEXICON = 50_000, 20_000
PRIOR_MASS, PRIOR_FLOOR = 500.0, 0.5
LEAST_Z = 3.0
DRIFT = 0.5
STEMS = (4, 5, 6)
THRESHOLD = 0.3
#: Evidence of a text without any run of toxic words.
NO_RUN = -4.0
_SEPARATORS = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
_REMEMBERED = 300_000
_BIN = 0.25


def words_of(body: bytes) -> list[bytes]:
    """Lower-case words; ASCII signs separate."""
    return body.decode("utf-8", "replace").lower().encode().translate(_SEPARATORS).split()


def _terms(words) -> set[bytes]:
    """What is counted: each word, and its first bytes as a stem, marked by a trailing space."""
    out = set(words)
    for n in STEMS:
        out.update(w[:n] + b" " for w in words if len(w) > n)
    return out


@dataclass
class Model:
    """A lexicon of log-odds, the extreme-value constants and the calibration; without labels every text has the score of ``NO_RUN``."""

    weights: dict[bytes, float]
    scale: float = 1.0
    log_k: float = -2.0
    slope: float = 1.0
    offset: float = -4.0

    def weight(self, word: bytes) -> float:
        """Log-odds of a word: its own or its best stem's, else the drift."""
        found = [self.weights[t] for t in (word, *(word[:n] + b" " for n in STEMS if len(word) > n)) if t in self.weights]
        return max(found) if found else -DRIFT

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-min(max(self.slope * evidence + self.offset, -30), 30)))


class _Weights(dict):
    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: bytes) -> float:
        value = self.model.weight(word)
        if len(self) < _REMEMBERED:
            self[word] = value
        return value


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring runs ``(start, end, score)`` of a sequence, in linear time.

    A run is maximal if all its parts score less and no longer run that holds it has
    that property. Candidates keep the sums before and behind them, and a link to
    the last earlier one whose sum before is smaller.
    """
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    kept: list[list] = []
    for at in np.flatnonzero(scores > 0).tolist():
        start, left, right = at, sums[at], sums[at + 1]
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= left:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= right:
                kept.append([start, at + 1, left, right, j])
                break
            start, left = kept[j][0], kept[j][2]
            del kept[j:]
    return [(s, e, float(r - l)) for s, e, l, r, _ in kept]


def significance(model: Model, body: bytes, weights: dict) -> tuple[float, list[tuple[int, int, float]]]:
    """Evidence of a text, and its passages ``(first word, word behind, excess)``.

    By the extreme-value law, clean text of ``n`` words is expected to hold
    ``K n exp(-score)`` runs of a scaled score or more. A passage's excess is its scaled
    score less the logarithm of ``K n``, of one at least, and it counts if that is
    positive. The evidence is the logarithm of the passages' summed odds and never
    negative with one; without a passage it is the best run's excess, which is at most
    0, and that of a text without any run is ``NO_RUN``, whatever its length.
    """
    words = words_of(body)
    if not words:
        return NO_RUN, []
    floor = max(0.0, model.log_k + math.log(len(words)))
    runs = segments(np.fromiter(map(weights.__getitem__, words), np.float64, len(words)))
    excess = [(s, e, model.scale * v - floor) for s, e, v in runs]
    good = [x for x in excess if x[2] > 0]
    if good:
        return max(0.0, float(np.logaddexp.reduce([x[2] for x in good]))), good
    return max((x[2] for x in excess), default=NO_RUN), []


def is_held_out(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 4 == 2


def _labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, most: int) -> DataFrame:
    """``(body, y)`` of labelled rows that aren't held out, at most about ``most`` by a hash of the id.

    Of the rows of a class whose texts have the same smallest shingle, as most copies have,
    one stays: a word that many copies of one text hold says little about its class.
    """
    known = (labels.select(F.col(key).alias("l_id"), F.col(label).cast("int").alias("y"))
             .filter(F.col("l_id").isNotNull() & F.col("y").isNotNull() & ~is_held_out(F.col("l_id")))
             .groupBy("l_id").agg(F.max("y").alias("y")))
    n = known.count()
    if n > most:
        known = known.filter(F.pmod(F.xxhash64("l_id"), F.lit(1_000_000)) < int(1_000_000 * most / n))
    # Its size is bounded by ``most``.
    rows = docs.select(F.col(key).alias("l_id"), utf8(text).alias("body")).join(F.broadcast(known), "l_id")
    kind = rows.schema["l_id"]
    sketched = settle_table(rows.transform(in_batches, _with_shingle, T.StructType([kind, *rows.drop("l_id").schema.fields, T.StructField("m", T.LongType())])))
    first = sketched.groupBy("m", "y").agg(F.min("l_id").alias("l_id"))
    return sketched.join(F.broadcast(first), ["m", "y", "l_id"]).select("body", "y")


def _with_shingle(batches):
    for batch in batches:
        least = []
        for body in batch.column("body"):
            words = words_of(body.as_py())
            least.append(min((xxhash.xxh3_64_intdigest(b" ".join(words[i:i + 5])) >> 1 for i in range(max(1, len(words) - 4)))))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least, pa.int64())], names=[*batch.schema.names, "m"])


def _count_terms(batches):
    for batch in batches:
        toxic: dict[bytes, int] = {}
        clean: dict[bytes, int] = {}
        for body, y in zip(batch.column("body"), batch.column("y").to_pylist()):
            held = toxic if y else clean
            for t in _terms(words_of(body.as_py())):
                held[t] = held.get(t, 0) + 1
        terms = [*toxic, *(t for t in clean if t not in toxic)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.binary()), pa.array([toxic.get(t, 0) for t in terms], pa.int64()),
             pa.array([clean.get(t, 0) for t in terms], pa.int64())], names=["term", "y1", "y0"])


def _contexts(candidates: frozenset[bytes]):
    """Each candidate term with a hash of its neighbour words, once per batch and class."""
    def run(batches):
        for batch in batches:
            seen: set[tuple[bytes, int, int]] = set()
            for body, y in zip(batch.column("body"), batch.column("y").to_pylist()):
                words = words_of(body.as_py())
                for i, w in enumerate(words):
                    found = _terms((w,)) & candidates
                    if found:
                        near = xxhash.xxh3_64_intdigest(b" ".join((*words[max(i - 1, 0):i], b"", *words[i + 1:i + 2]))) >> 1
                        seen.update((t, near, y) for t in found)
            rows = list(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.int32())], names=["term", "near", "y"])
    return run


def _log_odds(counts: DataFrame, n1: float, n0: float) -> DataFrame:
    """Add ``d``, the log-odds under a Dirichlet prior in proportion to overall frequency, and ``z``, in its standard deviations."""
    return (counts.withColumn("a", PRIOR_FLOOR + PRIOR_MASS * (F.col("y1") + F.col("y0")) / (n1 + n0))
            .withColumn("d", F.log((F.col("y1") + F.col("a")) / (n1 + PRIOR_MASS - F.col("y1") - F.col("a")))
                        - F.log((F.col("y0") + F.col("a")) / (n0 + PRIOR_MASS - F.col("y0") - F.col("a"))))
            .withColumn("z", F.col("d") / F.sqrt(1 / (F.col("y1") + F.col("a")) + 1 / (F.col("y0") + F.col("a")))))


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          most: int = MAX_LABELLED, candidates: int = MAX_CANDIDATES, lexicon: int = MAX_LEXICON) -> Model:
    """Fit the model on labelled rows whose id isn't held out.

    Spark counts the texts of each class that hold a term; the log-odds have a
    Dirichlet prior in proportion to the terms' overall frequency. The terms that stand
    out are then counted by distinct neighbour words, so that the copies of one text
    count once, and stay if still above ``LEAST_Z`` standard deviations. Without
    labels, or with one class only, the lexicon is empty. A null label or id says
    nothing; of several labels of an id the highest holds; a labelled id without a text is
    an empty one; every row of a repeated id is one more text of its label.
    """
    sample = settle_table(_labelled(docs, labels, key, text, label, most))
    counts = settle_table(sample.transform(in_batches, _count_terms, "term binary, y1 bigint, y0 bigint")
                          .groupBy("term").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0")))
    totals = counts.agg(F.sum("y1").alias("n1"), F.sum("y0").alias("n0")).first()
    n1, n0 = float(totals["n1"] or 0), float(totals["n0"] or 0)
    model = Model({})
    if not n1 or not n0:
        return model
    top = lambda rows, most: rows.filter(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "term").limit(most)
    standing = frozenset(bytes(r["term"]) for r in top(_log_odds(counts.filter("y1 >= 2"), n1, n0), candidates).select("term").collect())
    by_context = (sample.transform(in_batches, _contexts(standing), "term binary, near bigint, y int")
                  .groupBy("term", "near").agg(F.max(F.when(F.col("y") == 1, 1).otherwise(0)).alias("y1"),
                                               F.max(F.when(F.col("y") == 0, 1).otherwise(0)).alias("y0"))
                  .groupBy("term").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0")))
    kept = top(_log_odds(by_context.filter("y1 >= 3"), n1, n0), lexicon).select("term", "d", "y0").collect()
    model.weights = {bytes(r["term"]): float(r["d"]) for r in kept}
    if not kept:
        return model
    model.scale = _scale([float(r["d"]) for r in kept], [(float(r["y0"]) + 0.5) / n0 for r in kept])
    model.log_k = _log_k(model, sample)
    _calibrate(model, sample)
    return model


def _scale(weights: list[float], rates: list[float]) -> float:
    """The positive root of the mean of ``exp(scale * score)`` over clean terms at one."""
    w, p = np.array(weights), np.array(rates)
    rest = max(1 - p.sum(), 1e-9)
    low, high = 1e-3, 20.0
    for _ in range(60):
        mid = (low + high) / 2
        over = float((p * np.exp(np.minimum(mid * w, 700))).sum()) + rest * math.exp(-mid * DRIFT) > 1
        low, high = (low, mid) if over else (mid, high)
    return low


def best_run(model: Model, body: bytes, weights: dict) -> tuple[int, float]:
    """The number of words of a text and the scaled score of its best run, 0 without one."""
    words = words_of(body)
    if not words:
        return 0, 0.0
    runs = segments(np.fromiter(map(weights.__getitem__, words), np.float64, len(words)))
    return len(words), model.scale * max((v for *_, v in runs), default=0.0)


def _log_k(model: Model, sample: DataFrame) -> float:
    """The extreme-value law's constant: the likeliest one for the best runs of the clean texts, by their lengths.

    A best score ``s`` of ``n`` words has the density ``K n exp(-s - K n exp(-s))``, and none
    at all the probability ``exp(-K n)``; so K is the number of texts with a run over the
    sum of ``n exp(-s)``. Sums per task are added up.
    """
    def run(batches):
        weights, found, mass = _Weights(model), 0, 0.0
        for batch in batches:
            for b, y in zip(batch.column("body"), batch.column("y").to_pylist()):
                if not y:
                    n, s = best_run(model, b.as_py(), weights)
                    found += s > 0
                    mass += n * math.exp(-s)
        yield pa.RecordBatch.from_arrays([pa.array([found], pa.int64()), pa.array([mass], pa.float64())], names=["found", "mass"])

    sums = sample.transform(in_batches, run, "found bigint, mass double").agg(F.sum("found").alias("found"), F.sum("mass").alias("mass")).first()
    return math.log((sums["found"] + 0.5) / (sums["mass"] + 1.0))


def _calibrate(model: Model, sample: DataFrame) -> None:
    """Logistic calibration of the evidence, on counts in bins of the evidence."""
    def run(batches):
        weights = _Weights(model)
        for batch in batches:
            x = [significance(model, b.as_py(), weights)[0] for b in batch.column("body")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([round(min(max(v, -50), 200) / _BIN) for v in x], pa.int64()), batch.column("y").cast(pa.int64())], names=["x", "y"])

    bins = sample.transform(in_batches, run, "x bigint, y bigint").groupBy("x").agg(F.sum("y").alias("y1"), F.count("*").alias("n")).orderBy("x").collect()
    x = np.array([[r["x"] * _BIN, 1.0] for r in bins])
    y1, n = np.array([r["y1"] for r in bins], float), np.array([r["n"] for r in bins], float)
    beta, ridge = np.array([0.0, 0.0]), np.diag([0.05, 0.005])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y1 - n * p) - ridge @ beta)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    model.slope, model.offset = float(beta[0]), float(beta[1])


def score_texts(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, k_sha, score, predicted, passages`` for every row of ``docs``.

    ``passages`` are the significant toxic runs as word ranges with their excess. Null
    and empty texts get the score of text without evidence. Repeated rows stay; no
    other column is read; an empty table gives no rows.
    """
    slim = docs.select(F.col(key).alias("doc_id"), F.sha2(utf8(text), 256).alias("k_sha"), utf8(text).alias("body"))
    run_type = pa.list_(pa.struct([("first", pa.int64()), ("behind", pa.int64()), ("excess", pa.float64())]))

    def run(batches):
        weights = _Weights(model)
        for batch in batches:
            scores, runs = [], []
            for b in batch.column("body"):
                x, found = significance(model, b.as_py(), weights)
                scores.append(model.probability(x))
                runs.append([{"first": s, "behind": e, "excess": v} for s, e, v in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("k_sha"), pa.array(scores, pa.float64()),
                 pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()), pa.array(runs, run_type)],
                names=["doc_id", "k_sha", "score", "predicted", "passages"])

    passage = T.StructType([T.StructField("first", T.LongType()), T.StructField("behind", T.LongType()), T.StructField("excess", T.DoubleType())])
    schema = T.StructType([slim.schema["doc_id"], slim.schema["k_sha"], T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType()), T.StructField("passages", T.ArrayType(passage))])
    return slim.transform(in_batches, run, schema)


def drop_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold; all columns of the others stay.

    Null and empty texts hold no passage and stay; equal rows share their fate.
    """
    at = docs.columns.index(text)

    def run(batches):
        weights = _Weights(model)
        for batch in batches:
            keep = []
            for b in batch.column(at):
                x, _ = significance(model, (b.as_py() or "").encode(), weights)
                keep.append(model.probability(x) < THRESHOLD)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.transform(in_batches, run, docs.schema)
