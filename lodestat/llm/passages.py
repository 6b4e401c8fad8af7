"""Texts that share a passage of so many words with another one, by prefix doubling over words."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lodestat.llm.anchors import Ranks, runs, spread
from lodestat.llm.common import in_batches, mixed, slabs
from lodestat.operators.sizing import broadcast_checked
from lodestat.session import settle_table

WORDS = 50
_RUN = "k binary, start bigint, n int, fp bigint, whole bigint"


_SPACES = (b" ", b"\n", b"\t", b"\r", b"\v", b"\f")
_NEXT_SPACE = re.compile(rb"[ \t-\r]")
_LONG = 64
_GROUP = 1 << 16
_SPACE = np.isin(np.arange(256), list(b"".join(_SPACES)))
_VALUES = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_POWERS = np.full(_GROUP + 1, _BASE, np.uint64)
_POWERS[0] = 1
_POWERS = np.cumprod(_POWERS)
_INVERSE = np.full(_GROUP + 1, pow(_BASE, -1, 1 << 64), np.uint64)
_INVERSE[0] = 1
_INVERSE = np.cumprod(_INVERSE)


def _short_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts in up to ``_GROUP`` bytes, and its hash: a polynomial's value, from sums up to every byte."""
    codes = np.frombuffer(data, np.uint8)
    edges = np.diff(np.concatenate(([True], _SPACE[codes], [True])).view(np.int8))
    first, behind = np.flatnonzero(edges < 0), np.flatnonzero(edges > 0)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_VALUES[codes] * _POWERS[:len(codes)], out=sums[1:])
    hashes = (sums[behind] - sums[first]) * _INVERSE[first] + (behind - first).astype(np.uint64)
    for i in np.flatnonzero(behind - first > _LONG).tolist():
        hashes[i] = xxhash.xxh3_64_intdigest(data[first[i]:behind[i]])
    return first, hashes


def _group_hashes(bodies: list[bytes]) -> list[np.ndarray]:
    """Hashes of the words of each text; the texts have up to ``_GROUP`` bytes with a space between them."""
    first, hashes = _short_hashes(b" ".join(bodies))
    cuts = np.cumsum([len(b) + 1 for b in bodies])[:-1]
    return np.split(mixed(hashes), np.searchsorted(first, cuts))


def _parts(body: bytes) -> Iterator[bytes]:
    """A long text in parts of up to ``_GROUP`` bytes; a word is in one part, alone if it is longer."""
    at = 0
    while at < len(body):
        end = len(body) if len(body) - at <= _GROUP else max(body.rfind(s, at, at + _GROUP) for s in _SPACES) + 1
        if end <= at:
            behind = _NEXT_SPACE.search(body, at + _GROUP)
            end = behind.start() if behind else len(body)
        yield body[at:end]
        at = end


def _one_hashes(body: bytes) -> np.ndarray:
    """Hashes of the words of one text of any length."""
    made = [np.zeros(0, np.uint64)]
    for part in _parts(body):
        if len(part) <= _GROUP:
            made += _group_hashes([part])
        else:
            made.append(mixed(np.array([xxhash.xxh3_64_intdigest(w) for w in part.split()], np.uint64)))
    return np.concatenate(made)


def word_hashes(bodies: list[bytes]) -> list[np.ndarray]:
    """A 64-bit hash for each word of each text; ASCII white space separates."""
    out, held, size = [], [], 0
    for body in bodies:
        if held and size + len(body) + 1 > _GROUP:
            out += _group_hashes(held)
            held, size = [], 0
        if len(body) >= _GROUP:
            out.append(_one_hashes(body))
        else:
            held.append(body)
            size += len(body) + 1
    return out + (_group_hashes(held) if held else [])


def _run_rows(length: int):
    def rows(batches):
        for batch in batches:
            for first, bodies in slabs(batch.column("body")):
                for row, start, n, _, fp, whole in runs(word_hashes(bodies), length):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("k").take(pa.array(row + first)), pa.array(start), pa.array(n.astype(np.int32)), pa.array(fp), pa.array(whole)],
                        names=["k", "start", "n", "fp", "whole"])
    return rows


def _window_rows(length: int):
    """The hash of every window of the stated runs, with the kind of run that it is from."""
    def batch_of(found: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
        sizes = [len(w) for *_, w in found]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(np.repeat(np.array([f[i] for f in found], np.int64), sizes)) for i in (0, 1)), pa.array(np.concatenate([w for *_, w in found]))],
            names=["fp", "whole", "w"])

    def rows(batches):
        found, held = [], 0
        for batch in batches:
            for body, wanted in zip(batch.column("body"), batch.column("runs").to_pylist()):
                windows = spread(Ranks(word_hashes([body.as_py()])[0]).of(length)).view(np.int64)
                for r in wanted:
                    found.append((r["fp"], r["whole"], windows[r["start"]:r["start"] + r["n"]]))
                    held += r["n"]
                if held > 50_000:
                    yield batch_of(found)
                    found, held = [], 0
        if found:
            yield batch_of(found)
    return rows


def sharing_texts(keyed: DataFrame, length: int = WORDS) -> DataFrame:
    """``k`` of each text in ``keyed (k, body)`` that holds ``length`` words in a row which another text holds too, or that several rows hold.

    Ranks of half the length come first, one for each run of windows that share their
    least; Spark ranks them and drops those that one text alone has. Runs that are tied
    as wholes are settled. Of the others one per kind goes on, and its windows are
    ranked at the full length. Equal texts are one text there; each of them that is
    long enough has a first run.
    """
    live = settle_table(keyed.transform(in_batches, _run_rows(length), _RUN))
    copies = live.filter("start = 0").groupBy("k").agg(F.count("*").alias("c")).filter("c > 1").select("k")
    ends = [F.min("k").alias("lo"), F.max("k").alias("hi")]
    tied = settle_table(live.groupBy("fp").agg(*ends).filter("lo <> hi").select("fp"))
    live = settle_table(live.join(tied, "fp", "left_semi"))
    kinds = settle_table(live.groupBy("fp", "whole").agg(*ends, F.min(F.struct("k", "start", "n")).alias("one")))
    several = settle_table(kinds.groupBy("fp").agg(F.count("*").alias("c")).filter("c > 1").select("fp"))
    onward = kinds.join(several, "fp", "left_semi").select("one.*", "fp", "whole")
    wanted = settle_table(onward.groupBy("k").agg(F.collect_list(F.struct("start", "n", "fp", "whole")).alias("runs")))
    texts = keyed.join(broadcast_checked(wanted), "k").dropDuplicates(["k"])
    windows = settle_table(texts.transform(in_batches, _window_rows(length), "fp bigint, whole bigint, w bigint"))
    met = settle_table(windows.groupBy("w").agg(F.min("whole").alias("a"), F.max("whole").alias("b")).filter("a <> b").select("w"))
    same = kinds.filter("lo <> hi").select("fp", "whole").unionByName(windows.join(met, "w", "left_semi").select("fp", "whole")).distinct()
    return live.join(broadcast_checked(same), ["fp", "whole"], "left_semi").select("k").unionByName(copies).distinct()
