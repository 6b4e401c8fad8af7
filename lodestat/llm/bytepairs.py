"""Byte-level BPE of whole texts, as a reduction over a tree of neighbouring parts."""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Callable

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from lodestat.llm.common import in_batches, utf8

#: Characters of a text, and bytes of a match, that are encoded without halving.
TEXT_LEAF, MATCH_LEAF = 4096, 6
#: Bytes of a string that is merged without a heap, and how many leaves and pairs of tokens are remembered.
SHORT, REMEMBERED_PARTS, REMEMBERED_PAIRS = 32, 150_000, 200_000
#: Bits of a rank in the key of a pair.
SHIFT = 20
#: Characters behind a match's start that may decide between alternatives of the pattern: its longest literal.
REACH = 3
NONE = 1 << 62
#: Bytes of remembered matches in one task, in each of two generations, and the longest match that is remembered.
REMEMBERED_BYTES, LONGEST_KEPT = 32 << 20, 48
#: Unicode's white space, for use inside a character class.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_ENTRY_BYTES = 260


def read_ranks(file: str) -> dict[bytes, int]:
    """Ranks by bytes, from lines of a base64 token and its rank."""
    with open(file, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def pair_ranks(ranks: dict[bytes, int]) -> dict[int, int]:
    """The rank of what two neighbouring tokens make, by both ranks in one number."""
    if max(ranks.values(), default=0) >> SHIFT:
        raise ValueError(f"ranks of at most {SHIFT} bits")
    out = {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                out[left << SHIFT | right] = rank
    return out


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """All matches of ``pattern`` in a text; white space means Unicode's property, and ASCII texts take a plain pattern."""
    def spelled(space: str, letters: str, digits: str) -> str:
        classes = {r"[^\s\p{L}\p{N}]": f"[^{space}{letters}{digits}]", r"\p{L}": f"[{letters}]", r"\p{N}": f"[{digits}]",
                   r"\s": f"[{space}]", r"\S": f"[^{space}]"}
        return re.sub("|".join(map(re.escape, classes)), lambda m: classes[m[0]], pattern)

    whole = regex.compile(spelled(_SPACE, r"\p{L}", r"\p{N}")).findall
    ascii_ = re.compile(spelled(r"\t-\r ", "A-Za-z", "0-9")).findall
    return lambda text: ascii_(text) if text.isascii() else whole(text)


class BytePairs:
    """Encoder and decoder for a byte-level vocabulary of ranks.

    The parts of a text form a monoid: neighbours are joined by encoding a window
    around their border again, and the window grows until nothing outside it can change.

    * Text: matches are found from left to right, and what is found from a match's start
      on depends on nothing before it. So the left part's last matches are searched
      again, on into the right part, until a match there starts where the right
      part's own search had one; all others stay. A match is settled if it starts at
      least ``REACH`` characters before the end of what was searched and isn't the last.
    * Match: merges take the lowest rank first, the leftmost of equal ones. If every two
      neighbouring tokens, encoded alone, give themselves, then no merge over a border
      ever comes first, since up to then both sides merge as they would alone; so
      the sequence is the encoding. A window is large enough once the two pairs
      at its borders have that property.

    A match that is a token by itself is that token, whatever its merges give.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, splitter(pattern)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.single = [ranks.get(bytes([b])) for b in range(256)]
        self.merges = pair_ranks(ranks)
        self.decimals = {rank: b" %d" % rank for rank in self.tokens}
        self.pairs: dict[int, bool] = {}
        self.merged: dict[bytes, list[int]] = {}
        # Matches that were met lately, and those before them.
        self.known: dict[str, tuple[bytes, bytes, int]] = {}
        self.older: dict[str, tuple[bytes, bytes, int]] = {}
        self.held = 0

    def forget(self) -> "BytePairs":
        """Drop what was remembered, so that a worker process doesn't keep it between tasks."""
        for memory in (self.pairs, self.merged, self.known, self.older):
            memory.clear()
        self.held = 0
        return self

    def merge(self, body: bytes) -> list[int]:
        """Ranks of a string by merging neighbours one at a time, the lowest rank first, the leftmost of equal ones."""
        found = self.merged.get(body)
        if found is None:
            found = self._merge_short(body) if len(body) <= SHORT else self._merge_long(body)
            if len(body) <= MATCH_LEAF:
                if len(self.merged) >= REMEMBERED_PARTS:
                    self.merged.clear()
                self.merged[body] = found
        return found

    def _merge_short(self, body: bytes) -> list[int]:
        ids, rank = [self.single[b] for b in body], self.merges.get
        found = [rank(a << SHIFT | b, NONE) for a, b in zip(ids, ids[1:])]
        while found:
            best = min(found)
            if best == NONE:
                break
            at = found.index(best)
            ids[at:at + 2] = [best]
            del found[at]
            if at:
                found[at - 1] = rank(ids[at - 1] << SHIFT | best, NONE)
            if at < len(found):
                found[at] = rank(best << SHIFT | ids[at + 1], NONE)
        return ids

    def _merge_long(self, body: bytes) -> list[int]:
        """The same with a heap of neighbours, for windows over long repeated strings."""
        n, rank = len(body), self.ranks.get
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(body[i:i + 2])) is not None]
        heapq.heapify(heap)
        gone = bytearray(n + 1)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if gone[i] or j >= n or end[j] != stop:
                continue
            gone[j], end[i] = 1, stop
            if stop < n:
                before[stop] = i
                if (r := rank(body[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if before[i] >= 0 and (r := rank(body[before[i]:stop])) is not None:
                heapq.heappush(heap, (r, before[i], stop))
        out, at = [], 0
        while at < n:
            out.append(self.ranks[body[at:end[at]]])
            at = end[at]
        return out

    def stable(self, left: int, right: int) -> bool:
        """True when no merge crosses the border of two neighbouring tokens."""
        pair = left << SHIFT | right
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= REMEMBERED_PAIRS:
                self.pairs.clear()
            body = self.tokens[left] + self.tokens[right]
            known = self.pairs[pair] = (self._merge_short(body) if len(body) <= SHORT else self._merge_long(body)) == [left, right]
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring strings together, from both encodings."""
        if not left or not right or self.stable(left[-1], right[0]):
            return left + right
        i, j = 1, 1
        while True:
            window = self.merge(b"".join(map(self.tokens.__getitem__, left[len(left) - i:] + right[:j])))
            fits_left = i == len(left) or self.stable(left[-i - 1], window[0])
            fits_right = j == len(right) or self.stable(window[-1], right[j])
            if fits_left and fits_right:
                return left[:len(left) - i] + window + right[j:]
            i = min(len(left), 2 * i) if not fits_left else i
            j = min(len(right), 2 * j) if not fits_right else j

    def encode_bytes(self, body: bytes) -> list[int]:
        """Ranks of one match: its halves' ranks, joined."""
        if len(body) <= MATCH_LEAF:
            return self.merge(body)
        middle = len(body) // 2
        return self.join(self.encode_bytes(body[:middle]), self.encode_bytes(body[middle:]))

    def encode_match(self, body: bytes) -> list[int]:
        whole = self.ranks.get(body)
        return [whole] if whole is not None else self.encode_bytes(body)

    def matches(self, text: str) -> list[str]:
        """The pattern's matches: those of both halves, joined."""
        if len(text) <= TEXT_LEAF:
            return self.split(text)
        middle = len(text) // 2
        return self.join_matches(self.matches(text[:middle]), self.matches(text[middle:]))

    def join_matches(self, left: list[str], right: list[str]) -> list[str]:
        if not left or not right:
            return left + right
        # What the left part's last match, or one that starts within reach of its end, is depends on the right part too.
        again, near = 1, len(left[-1])
        while again < len(left) and near < REACH:
            again += 1
            near += len(left[-again])
        tail, taken = "".join(left[-again:]), 1
        while True:
            own = right[:taken]
            window = tail + "".join(own)
            found = self.split(window)
            if taken == len(right):
                return left[:-again] + found
            starts, at = {}, len(tail)
            for k, m in enumerate(own):
                starts[at] = k
                at += len(m)
            at = 0
            for k, m in enumerate(found):
                if at + len(m) == len(window) or at + REACH > len(window):
                    break
                at += len(m)
                if at in starts:
                    return left[:-again] + found[:k + 1] + right[starts[at]:]
            taken = min(len(right), 2 * taken)

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of both halves of ``ids``, one behind the other."""
        if len(ids) <= TEXT_LEAF:
            return b"".join(map(self.tokens.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])

    def encode(self, text: str) -> list[int]:
        """Ranks of a whole text, without special tokens."""
        out: list[int] = []
        for m in self.matches(text):
            out += self.encode_match(m.encode())
        return out

    def described(self, match: str) -> tuple[bytes, bytes, int]:
        """Decimal ids behind a space each, the bytes that they decode to, and their number; remembered up to a bound."""
        value = self.known.get(match) or self.older.get(match)
        if value is None:
            ids = self.encode_match(match.encode())
            value = (b"".join([self.decimals[i] for i in ids]), self.decode(ids), len(ids))
        if len(match) <= LONGEST_KEPT:
            size = _ENTRY_BYTES + 2 * len(match) + len(value[0])
            if self.held + size > REMEMBERED_BYTES:
                self.known, self.older, self.held = {}, self.known, 0
            self.known[match] = value
            self.held += size
        return value

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, and SHA-256 of the decimal ids joined by spaces and of the decoded bytes."""
        matches = self.matches(text)
        n, ids, bodies = 0, hashlib.sha256(), hashlib.sha256()
        for at in range(0, len(matches), TEXT_LEAF):
            known = self.known.get
            found = [known(m) or self.described(m) for m in matches[at:at + TEXT_LEAF]]
            numbers = b"".join([f[0] for f in found])
            ids.update(numbers if at else numbers[1:])
            bodies.update(b"".join([f[1] for f in found]))
            n += sum([f[2] for f in found])
        return n, ids.hexdigest(), bodies.hexdigest()


_CODERS: dict[tuple[str, str], BytePairs] = {}


def coder(file: str, pattern: str) -> BytePairs:
    """One coder for each worker process, since its tables take long to make; it remembers nothing of earlier tasks."""
    if (file, pattern) not in _CODERS:
        _CODERS[file, pattern] = BytePairs(read_ranks(file), pattern)
    return _CODERS[file, pattern].forget()


def _texts(batch: pa.RecordBatch):
    for body in batch.column("body"):
        yield body.as_py().decode("utf-8", "replace")


def encode_texts(docs: DataFrame, file: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids``: the ranks of every row's whole text, without special tokens.

    Null and empty texts have no ids; bytes that aren't UTF-8 count as U+FFFD. Repeated
    rows stay; other columns are not read; an empty table gives no rows. ``file`` must
    exist on every executor.
    """
    def run(batches):
        own = coder(file, pattern)
        for batch in batches:
            ids = [own.encode(t) for t in _texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    slim = docs.select(F.col(key).alias("doc_id"), utf8(text).alias("body"))
    return slim.transform(in_batches, run, T.StructType([slim.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode_ids(encoded: DataFrame, file: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id, body``: the bytes that lists of ids stand for; a null list stands for none, an unknown id is an error."""
    def run(batches):
        own = coder(file, "")
        for batch in batches:
            bodies = [own.decode(i.as_py() or []) for i in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bodies, pa.binary())], names=["doc_id", "body"])

    slim = encoded.select(F.col(key).alias("doc_id"), F.col(ids).alias("ids"))
    return slim.transform(in_batches, run, T.StructType([slim.schema["doc_id"], T.StructField("body", T.BinaryType())]))


def round_trip(docs: DataFrame, file: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row of ``docs``, with the cases of ``encode_texts``.

    Ids are digested match by match, so no list of a long text's ids leaves the task.
    """
    def run(batches):
        own = coder(file, pattern)
        for batch in batches:
            found = [own.digest(t) for t in _texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string()),
                 pa.array([f[2] for f in found], pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    slim = docs.select(F.col(key).alias("doc_id"), utf8(text).alias("body"))
    schema = T.StructType([slim.schema["doc_id"], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType())])
    return slim.transform(in_batches, run, schema)
