"""Token ids of whole texts, with words remembered between texts."""

from __future__ import annotations

import string
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np

#: Bytes of words and ids that one task remembers, with what Python adds to each.
REMEMBERED_BYTES = 32 << 20
_ENTRY_BYTES = 180
_LONGEST_KEPT = 64
_JOINED = 2_000
_SIGNS = string.punctuation.encode()


def _byte_signs() -> list[str]:
    """The sign that a byte-level vocabulary writes for each byte: itself if printable, else the next one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    later = iter(range(256, 512))
    return [chr(b if b in plain else next(later)) for b in range(256)]


def _ends_in_letter(word: bytes) -> bool:
    """Whether the last sign is an ASCII letter or a lower-case one below U+0250; the capital I with a dot ends in a mark when lower-cased."""
    if word[-1:].isascii():
        return word[-1:].isalpha()
    last = word[-2:].decode("utf-8", "replace")
    return len(last) == 1 and last < "\u0250" and last.isalpha() and last.islower()


class WordIds:
    """Ids of texts by a tokenizer that drops white space and joins no word over it.

    Texts are cut at ASCII white space; the tokenizer itself encodes each new word, many
    at a time with a special token between them, so ids equal those of the whole text. The
    special token's own string inside a word is encoded alone, and words of Latin
    letters that are in lower case already go to the tokenizer's model directly.
    """

    def __init__(self, file: str, between: str = "<|endoftext|>"):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.between, self.mark = between, self.tokenizer.token_to_id(between)
        self.known: dict[bytes, bytes] = {}
        self.held = 0
        self.model, self.signs = self.tokenizer.model, _byte_signs()
        ids = np.arange(self.tokenizer.get_vocab_size(), dtype="<u4").tobytes()
        self.id_bytes = [ids[at:at + 4] for at in range(0, len(ids), 4)]

    def _encode(self, words: set[bytes]) -> dict[bytes, bytes]:
        found = {}
        plain = []
        tokenize, signs, id_bytes = self.model.tokenize, self.signs, self.id_bytes
        for w in words:
            if w.isascii():
                written = w.decode() if w.isalpha() and w.islower() else None
            else:
                text = w.decode("utf-8", "replace")
                # Below U+0250 every text is in normal form.
                written = "".join([signs[b] for b in w]) if text.isalpha() and text == text.lower() and max(text) < "\u0250" else None
            if written is not None:
                found[w] = b"".join([id_bytes[t.id] for t in tokenize(written)])
            elif b"<|" in w or len(w) > 1000:
                found[w] = np.array(self.tokenizer.encode(w.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()
            else:
                plain.append(w)
        for at in range(0, len(plain), _JOINED):
            part = plain[at:at + _JOINED]
            text = f" {self.between} ".join(w.decode("utf-8", "replace") for w in part)
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(ids == self.mark)
            begin, end = np.concatenate(([0], cuts + 1)).tolist(), np.concatenate((cuts, [len(ids)])).tolist()
            data = ids.tobytes()
            found.update((w, data[4 * b:4 * e]) for w, b, e in zip(part, begin, end, strict=True))
        return found

    def _add(self, new: set[bytes]) -> list[bytes]:
        """Learn words; those beyond the bound are returned.

        Signs behind a letter are tokens of their own, so most words with such are put together from others; that is
        cheap enough to do again, so they take at most half of what is remembered.
        """
        known = self.known
        joined, wanted = [], set()
        for w in new:
            stem = w.rstrip(_SIGNS)
            if len(stem) < len(w) and _ends_in_letter(stem) and b"<|" not in w:
                joined.append(w)
                wanted.add(stem)
                wanted.add(w[len(stem):])
            else:
                wanted.add(w)
        fresh = self._encode(wanted.difference(known))
        known.update(fresh)
        whole = {}
        for w in joined:
            stem = w.rstrip(_SIGNS)
            whole[w] = known[stem] + known[w[len(stem):]]
        known.update(whole)
        return self._beyond(fresh, REMEMBERED_BYTES) + self._beyond(whole, REMEMBERED_BYTES // 2)

    def _beyond(self, learnt: dict[bytes, bytes], most: int) -> list[bytes]:
        """Of words just learnt, those that are not to be remembered with ``most`` bytes in all."""
        size = _ENTRY_BYTES * len(learnt) + sum(map(len, learnt)) + sum(map(len, learnt.values()))
        if self.held + size <= most:
            self.held += size
            return []
        beyond = []
        for w, i in learnt.items():
            if self.held >= most or len(w) > _LONGEST_KEPT:
                beyond.append(w)
            else:
                self.held += _ENTRY_BYTES + len(w) + len(i)
        return beyond

    def forget(self) -> None:
        """Give back the words' memory, which a worker process would else keep through later stages."""
        self.known.clear()
        self.held = 0

    def encode(self, bodies: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        # The tokenizer lower-cases, but looks for its special tokens before that.
        split = [(b if b"<|" in b else b.lower()).split() for b in bodies]
        beyond = self._add(set().union(*split).difference(self.known))
        ids = self.known.__getitem__
        out = [b"".join(map(ids, words)) for words in split]
        for w in beyond:
            del self.known[w]
        return out


_ENCODERS: dict[str, WordIds] = {}


@contextmanager
def encoder(file: str) -> Iterator[WordIds]:
    """One encoder for each worker process, since the vocabulary takes long to read; its words are forgotten at the end of a task."""
    if file not in _ENCODERS:
        _ENCODERS[file] = WordIds(file)
    try:
        yield _ENCODERS[file]
    finally:
        _ENCODERS[file].forget()
