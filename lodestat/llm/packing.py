"""Packing of documents into fixed token windows by non-negative least squares."""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from lodestat.llm.common import in_batches, row_key, slabs, union_all
from lodestat.llm.tokens import encoder
from lodestat.operators.sizing import broadcast_checked
from lodestat.session import settle_table

WINDOW, UNIT, LEAST = 4096, 16, 256
_CHUNK = 100_000
#: Bytes of texts that go to a task's Python at once, and that are split into words at once, which takes many times their size.
_BATCH, _SLAB = 4 << 20, 1 << 20


def combinations(top: int, least: int) -> list[dict[int, int]]:
    """Multisets of lengths from ``least`` to ``top`` that add up to ``top``: repeats of at most two lengths, or three different ones."""
    out: dict[tuple, dict[int, int]] = {}
    for a in range(least, top + 1):
        for i in range(1, top // a + 1):
            rest = top - i * a
            if rest == 0:
                out[((a, i),)] = {a: i}
            for b in range(a + 1, rest + 1):
                if rest % b == 0:
                    out[((a, i), (b, rest // b))] = {a: i, b: rest // b}
        for b in range(a + 1, (top - a) // 2 + 1):
            c = top - a - b
            if c > b:
                out[((a, 1), (b, 1), (c, 1))] = {a: 1, b: 1, c: 1}
    return list(out.values())


def nonnegative_least_squares(matrix: np.ndarray, goal: np.ndarray, most: int = 1000) -> np.ndarray:
    """``x >= 0`` with the least ``|matrix @ x - goal|``, by the active-set method."""
    n = matrix.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    gram, target = matrix.T @ goal, matrix
    slack = gram.copy()
    for _ in range(most):
        slack[active] = -np.inf
        pick = int(np.argmax(slack)) if n else 0
        if not n or slack[pick] <= 1e-6 * max(1.0, float(np.abs(gram).max())):
            break
        active[pick] = True
        while True:
            index = np.flatnonzero(active)
            z = np.linalg.lstsq(target[:, index], goal, rcond=None)[0]
            if (z > 1e-12).all():
                x[:] = 0
                x[index] = z
                break
            held = x[index]
            low = z <= 1e-12
            step = float(np.min(held[low] / np.maximum(held[low] - z[low], 1e-300)))
            x[index] = held + step * (z - held)
            drop = index[(x[index] <= 1e-12)]
            x[drop], active[drop] = 0, False
            if not active.any():
                break
        slack = matrix.T @ (goal - matrix @ x)
    return x


@dataclass
class Plan:
    """Which pieces of each length bin go where: ``(bin, from rank, behind, first sequence, place)``, and how many sequences."""

    ranges: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0


def plan(histogram: dict[int, int], window: int = WINDOW, unit: int = UNIT, least: int = LEAST) -> Plan:
    """Repeat counts of the combinations, from the counts of pieces per bin of ``unit`` tokens.

    The least-squares repeats are rounded down and held to the pieces there are; then
    each combination takes what is left for it. Pieces that no combination takes stay
    without a range. The work depends on the number of bins only.
    """
    top, low = window // unit, least // unit
    ways = [w for w in combinations(top, low) if all(histogram.get(a, 0) >= i for a, i in w.items())]
    left, given, out = dict(histogram), dict.fromkeys(histogram, 0), Plan()
    if not ways:
        return out
    matrix = np.zeros((top + 1, len(ways)))
    for j, w in enumerate(ways):
        for a, i in w.items():
            matrix[a, j] = i
    goal = np.array([histogram.get(a, 0) for a in range(top + 1)], float)
    repeats = nonnegative_least_squares(matrix, goal)
    order = np.argsort(-repeats, kind="stable").tolist()
    for wanted in ([int(repeats[j]) for j in order], [None] * len(order)):
        for j, n in zip(order, wanted):
            room = min(left.get(a, 0) // i for a, i in ways[j].items())
            n = room if n is None else min(n, room)
            if n <= 0:
                continue
            place = 0
            for a, i in sorted(ways[j].items(), reverse=True):
                for _ in range(i):
                    out.ranges.append((a, given[a], given[a] + n, out.sequences, place))
                    given[a] += n
                    place += 1
                left[a] -= n * i
            out.sequences += n
    return out


def tail_cuts(total: int, window: int) -> list[int]:
    """Lengths of the last sequences of a stream: the powers of two that make up what exceeds whole windows."""
    rest = total % window
    return [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _tokenized(file: str, end_id: int, window: int):
    last = np.array([end_id], "<u4").tobytes()

    def encoded(words, batch):
        tokens, crcs, tail = [], [], []
        for _, bodies in slabs(batch.column("body"), _SLAB):
            for ids in words.encode(bodies):
                ids += last
                n = len(ids) // 4
                full = n // window * window
                tokens.append(n)
                crcs.append([zlib.crc32(ids[4 * at:4 * (at + window)]) for at in range(0, full, window)])
                tail.append(zlib.crc32(ids[4 * full:]))
        return pa.RecordBatch.from_arrays(
            [batch.column("k_id"), batch.column("k_sha"), pa.array(tokens, pa.int64()), pa.array(crcs, pa.list_(pa.int64())),
             pa.array(tail, pa.int64())], names=["k_id", "k_sha", "tokens", "crcs", "tail_crc"])

    def run(batches):
        with encoder(file) as words:
            for batch in batches:
                yield encoded(words, batch)
    return run


def _cut_sums(file: str, end_id: int):
    """Checksums of stated stretches of each text's ids."""
    last = np.array([end_id], "<u4").tobytes()

    def summed(words, batch):
        rows = {"k_id": [], "k_sha": [], "start": [], "length": [], "cut_crc": []}
        for first, bodies in slabs(batch.column("body"), _SLAB):
            for i, ids in enumerate(words.encode(bodies), first):
                ids += last
                for cut in batch.column("cuts")[i].as_py():
                    rows["k_id"].append(batch.column("k_id")[i].as_py())
                    rows["k_sha"].append(batch.column("k_sha")[i].as_py())
                    rows["start"].append(cut["start"])
                    rows["length"].append(cut["length"])
                    rows["cut_crc"].append(zlib.crc32(ids[4 * cut["start"]:4 * (cut["start"] + cut["length"])]))
        return pa.RecordBatch.from_arrays(
            [pa.array(rows["k_id"], batch.schema.field("k_id").type), pa.array(rows["k_sha"], pa.string()),
             *(pa.array(rows[c], pa.int64()) for c in ("start", "length", "cut_crc"))], names=list(rows))

    def run(batches):
        with encoder(file) as words:
            for batch in batches:
                yield summed(words, batch)
    return run


def _offsets(rows: DataFrame, group: list[str], part: str, amount, name: str) -> DataFrame:
    """Sums of ``amount`` over the parts of each group that come before a part; one row per group and part."""
    over = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return (rows.groupBy(*group, part).agg(amount.alias("_n"))
            .withColumn(name, F.coalesce(F.sum("_n").over(over), F.lit(0)).cast("long")).drop("_n"))


def pack(docs: DataFrame, file: str, key: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = 2) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A text's ids are followed by ``end_id``. Whole windows of long texts are sequences of
    their own. Remainders from ``LEAST`` tokens on are binned by length and combined
    by ``plan``; shorter ones, and those the plan leaves over, follow each other in one
    stream that is cut at every window, its end into powers of two, so that only combined
    sequences have padding, of less than ``UNIT`` tokens a piece. Null counts as
    empty: one token. Repeated rows are packed each. An empty table gives no rows. Other
    columns are not read. The driver gets the histogram of bins only.
    """
    keyed = row_key(docs, key, text)
    fields = [keyed.schema["k_id"], keyed.schema["k_sha"], T.StructField("tokens", T.LongType()),
              T.StructField("crcs", T.ArrayType(T.LongType())), T.StructField("tail_crc", T.LongType())]
    rows = settle_table(keyed.transform(in_batches, _tokenized(file, end_id, window), T.StructType(fields), _BATCH)
                        .withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()))
    tail = F.col("tokens") % window
    rows = rows.withColumn("tail", tail).withColumn("tail_start", F.col("tokens") - tail)
    unit = F.when(tail >= LEAST, F.ceil(tail / UNIT).cast("int")).otherwise(0)
    tails = rows.filter("tail > 0").drop("crcs").withColumn("bin", unit)
    histogram = {r["bin"]: r["n"] for r in tails.filter("bin > 0").groupBy("bin").agg(F.count("*").alias("n")).collect()}
    made = plan(histogram, window)
    spark = docs.sparkSession

    before = _offsets(tails, ["bin"], "part", F.count("*"), "before")
    rank = F.row_number().over(Window.partitionBy("bin", "part").orderBy("at"))
    ranked = tails.withColumn("rank", rank.cast("long")).join(before, ["bin", "part"]).withColumn("rank", F.col("rank") - 1 + F.col("before")).drop("before")
    # At most a few ranges for each combination of bins, whatever the input.
    ranges = F.broadcast(spark.createDataFrame(made.ranges, "r_bin int, low long, behind long, first long, place int"))
    placed = settle_table(ranked.join(ranges, (F.col("bin") == F.col("r_bin")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("behind")), "left")
                          .drop("r_bin", "behind"))
    piece = ["k_id", "k_sha", "start", "length", "ids_crc32", "tokens", "sequence_id", "offset"]

    in_sequence = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    combined = (placed.filter("place is not null").withColumn("sequence_id", F.col("first") + F.col("rank") - F.col("low"))
                .withColumn("offset", F.coalesce(F.sum("tail").over(in_sequence), F.lit(0)).cast("long"))
                .select("k_id", "k_sha", F.col("tail_start").alias("start"), F.col("tail").alias("length"),
                        F.col("tail_crc").alias("ids_crc32"), "tokens", "sequence_id", "offset").select(*piece))

    stream = placed.filter("place is null").withColumn("chunk", F.floor(F.col("rank") / _CHUNK))
    stream = stream.withColumn("at", F.struct("bin", "chunk"))
    flat = stream.withColumn("g", F.lit(0))
    ahead = _offsets(flat, ["g"], "at", F.sum("tail"), "ahead").drop("g")
    total = stream.agg(F.coalesce(F.sum("tail"), F.lit(0))).first()[0]
    inside = Window.partitionBy("at").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    whole = total // window
    lengths = tail_cuts(total, window)
    edges = np.cumsum([whole * window, *lengths]).tolist()
    spots = (stream.join(ahead, "at").withColumn("from", F.col("ahead") + F.coalesce(F.sum("tail").over(inside), F.lit(0)))
             .withColumn("to", F.col("from") + F.col("tail")))
    cuts = F.array_sort(F.array_distinct(F.concat(
        F.array("from"), F.transform(F.sequence(F.floor(F.col("from") / window) + 1, F.floor((F.col("to") - 1) / window) + 1), lambda k: k * window),
        F.array(*[F.lit(e).cast("long") for e in edges]), F.array("to"))))
    cuts = F.filter(cuts, lambda c: (c >= F.col("from")) & (c <= F.col("to")))
    pieces = (spots.withColumn("c", cuts).select("*", F.posexplode(F.slice("c", 1, F.size("c") - 1)).alias("k", "begin"))
              .withColumn("end", F.element_at("c", F.col("k") + 2)))
    # Behind the whole windows, each later edge starts a sequence.
    later = sum((F.when(F.col("begin") >= e, 1).otherwise(0) for e in edges[1:]), F.lit(0))
    number = F.when(F.col("begin") < edges[0], F.floor(F.col("begin") / window)).otherwise(F.lit(whole) + later)
    start_of = F.lit(edges[0]).cast("long")
    for e in edges[1:]:
        start_of = F.when(F.col("begin") >= e, F.lit(e)).otherwise(start_of)
    base = F.when(F.col("begin") < edges[0], F.floor(F.col("begin") / window) * window).otherwise(start_of)
    pieces = (pieces.withColumn("length", F.col("end") - F.col("begin")).withColumn("start", F.col("tail_start") + F.col("begin") - F.col("from"))
              .withColumn("sequence_id", (F.lit(made.sequences) + number).cast("long")).withColumn("offset", (F.col("begin") - base).cast("long"))
              .withColumn("is_cut", F.col("length") < F.col("tail")))
    pieces = settle_table(pieces.select("k_id", "k_sha", "start", "length", "tail_crc", "tokens", "sequence_id", "offset", "is_cut"))
    wanted = (pieces.filter("is_cut").groupBy("k_id", "k_sha").agg(F.collect_set(F.struct("start", "length")).alias("cuts"))
              .withColumnsRenamed({"k_id": "w_id", "k_sha": "w_sha"}))
    again = keyed.join(broadcast_checked(wanted), F.col("k_id").eqNullSafe(F.col("w_id")) & (F.col("k_sha") == F.col("w_sha"))).drop("w_id", "w_sha")
    sums = again.transform(in_batches, _cut_sums(file, end_id), T.StructType(
        [fields[0], fields[1], *(T.StructField(c, T.LongType()) for c in ("start", "length", "cut_crc"))]), _BATCH).distinct()
    p, s = pieces.filter("is_cut").alias("p"), sums.alias("s")
    cut = p.join(s, F.col("p.k_id").eqNullSafe(F.col("s.k_id")) & (F.col("p.k_sha") == F.col("s.k_sha"))
                 & (F.col("p.start") == F.col("s.start")) & (F.col("p.length") == F.col("s.length"))).select("p.*", F.col("s.cut_crc").alias("ids_crc32"))
    uncut = pieces.filter("not is_cut").withColumn("ids_crc32", F.col("tail_crc"))

    long_ = rows.filter("size(crcs) > 0")
    ahead_of = _offsets(long_.withColumn("g", F.lit(0)), ["g"], "part", F.sum(F.size("crcs")), "ahead").drop("g")
    own = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    first = made.sequences + whole + len(lengths)
    full = (long_.withColumn("earlier", F.coalesce(F.sum(F.size("crcs")).over(own), F.lit(0))).join(ahead_of, "part")
            .select("k_id", "k_sha", "tokens", "earlier", "ahead", F.posexplode("crcs").alias("k", "ids_crc32"))
            .select("k_id", "k_sha", (F.col("k") * window).cast("long").alias("start"), F.lit(window).cast("long").alias("length"), "ids_crc32", "tokens",
                    (F.lit(first) + F.col("ahead") + F.col("earlier") + F.col("k")).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    out = union_all([combined, cut.select(*piece), uncut.select(*piece), full.select(*piece)])
    return out.select(F.col("k_id").alias("doc_id"), "start", "length", "ids_crc32", F.col("tokens").alias("doc_tokens"), "sequence_id", "offset")
