"""Token counts of a unigram vocabulary, without building the tokens."""

from __future__ import annotations

import math
import re

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from lodestat.llm.common import in_batches

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 400_000
_LONGEST_KEPT = 64
_SEGMENT = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


class UnigramCounter:
    """Counts pieces of the best segmentation under a unigram vocabulary with byte fallback.

    ``pieces`` are (string, score) pairs. Rules: the highest total score wins, in
    double precision; of equal totals the longest last piece stays; a character that no
    piece equals may also be unknown, at the lowest score less 10, and counts one
    piece for each of its UTF-8 bytes. Pieces that mix a space mark with a later space
    mark behind other characters are refused, so that words can be counted one by one.
    """

    def __init__(self, pieces: list[tuple[str, float]]):
        self.matcher = ahocorasick.Automaton()
        for piece, score in pieces:
            if SPACE in piece.lstrip(SPACE):
                raise ValueError(f"a piece crosses words: {piece!r}")
            self.matcher.add_word(piece, (len(piece), score))
        self.matcher.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.words = _Words(self)

    def segment(self, word: str) -> complex:
        """Piece count (real part) and score (imaginary part) of one segment, so that both add up in one pass."""
        n, nothing = len(word), float("-inf")
        best, count = [nothing] * (n + 1), [0] * (n + 1)
        best[0], open_ = 0.0, 1

        def close(upto: int) -> None:
            # A character without a piece of its own may be unknown; a later start wins only by a higher score.
            for j in range(open_, upto + 1):
                if word[j - 1] not in self.single and best[j - 1] + self.unknown > best[j]:
                    best[j] = best[j - 1] + self.unknown
                    count[j] = count[j - 1] + len(word[j - 1].encode())

        for end, (size, score) in self.matcher.iter(word):
            if end + 1 > open_:
                close(end)
                open_ = end + 1
            j, total = end + 1, best[end + 1 - size] + score
            if total > best[j]:
                best[j], count[j] = total, count[j - size] + 1
        close(n)
        return complex(count[n], best[n])

    def count(self, text: str) -> complex:
        if not text:
            return 0j
        if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
            total = 0j
            for w in _SEGMENT.findall(SPACE + text.replace(" ", SPACE)):
                total += self.words[w[1:]] if w[0] == SPACE and w[1:2] != SPACE else self.segment(w)
            return total
        return sum(map(self.words.__getitem__, text.split(" ")), 0j)


class _Words(dict):
    """Counts of words behind one space mark, remembered up to a bound."""

    def __init__(self, counter: UnigramCounter):
        super().__init__()
        self.counter = counter

    def __missing__(self, word: str) -> complex:
        value = self.counter.segment(SPACE + word)
        if len(self) < REMEMBERED and len(word) <= _LONGEST_KEPT:
            self[word] = value
        return value


def read_pieces(model_file: str) -> list[tuple[str, float]]:
    """Ordinary pieces of a vocabulary file with log-probabilities by Zipf's law.

    Pieces of a merge vocabulary stand in the order in which they were merged, from the
    most frequent on, and carry no probabilities. So the piece at place ``r`` from 1 has the
    probability ``1 / r`` over the sum of all; nothing is trained. Control, unknown and byte
    entries stay out.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_file)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    total = math.log(sum(1 / r for r in range(1, len(pieces) + 1)))
    return [(p, -math.log(r) - total) for r, p in enumerate(pieces, 1)]


_COUNTERS: dict[str, UnigramCounter] = {}


def _counter(model_file: str) -> UnigramCounter:
    """One counter for each worker process, since its automaton and words serve many batches."""
    if model_file not in _COUNTERS:
        _COUNTERS[model_file] = UnigramCounter(read_pieces(model_file))
    return _COUNTERS[model_file]


def count_tokens(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, score`` for every row of ``docs``: pieces of the whole text and their total score.

    A space mark stands before the text and for each of its spaces. Null and empty texts
    have no tokens and score 0. Repeated rows stay; other columns are not read; an
    empty table gives no rows. ``model_file`` must exist on every executor.
    """
    def run(batches):
        counter = _counter(model_file)
        for batch in batches:
            texts = pc.fill_null(batch.column("body"), "")
            found = [counter.count(t.as_py()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([int(c.real) for c in found], pa.int64()),
                 pa.array([c.imag for c in found], pa.float64())], names=["doc_id", "n_tokens", "score"])

    slim = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("body"))
    schema = T.StructType([slim.schema["doc_id"], T.StructField("n_tokens", T.LongType()), T.StructField("score", T.DoubleType())])
    return slim.transform(in_batches, run, schema)
