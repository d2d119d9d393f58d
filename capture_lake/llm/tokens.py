"""Token ids of whole texts by a public tokenizer file (never trained here).

`BpeIds` gives exactly the ids of the file's own tokenizer.  Byte-pair merges
never cross the tokenizer's word pattern, nor white space, so the ids of each
run without white space are kept in a bounded table per worker, and a text is a
join of its runs' ids.  Words that aren't in the table yet go through the file's
merges; what lies beyond Latin-1 goes through the whole tokenizer.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np

#: Bytes of a worker's table; as many again are kept that were in use before those.
MAX_BYTES = 48 * 1024 * 1024
#: Runs of more characters than this (texts without blanks) are not remembered.
LONG_RUN = 64
#: Characters of text whose runs are held at once.
CHARS_AT_ONCE = 1 << 20

# The word pattern of the tokenizer file, for lower-case Latin-1 text.
_LETTER = "a-zªµºß-öø-ÿ"
_NUMBER = "0-9²³¹¼-¾"
_SPACE = "\t-\r \u0085\u00a0"
WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")
#: The sign of a byte that has none of its own: byte-level vocabularies write such bytes, in order,
#: as the characters from 256 on.
_SIGNLESS = [*range(33), *range(127, 161), 173]
BYTE_SIGNS = {b: 256 + k for k, b in enumerate(_SIGNLESS)}
#: A full stop or comma next to another mark, with which it makes one word.
MARKS_TOGETHER = re.compile(f"[.,](?:[^{_SPACE}{_LETTER}{_NUMBER}]|(?<=[^{_SPACE}{_LETTER}{_NUMBER}].))", re.S)
#: str.split takes these for white space, the tokenizer doesn't.
ODD_SPACE = "\x1c\x1d\x1e\x1f"
SPACE = re.compile(f"(?:[^\\s]|[{ODD_SPACE}])+")


class _Table:
    """A table of ids bounded by bytes: when it is full it becomes the older one, and entries in use come
    back from there."""

    def __init__(self):
        self.now: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.size = 0

    def grown(self, keys) -> None:
        """Count the bytes of new entries (and of their places in the table)."""
        now, size = self.now, sys.getsizeof
        self.size += sum(size(k) + size(now[k]) + 100 for k in keys)

    def forget_long(self, keys: set[str]) -> None:
        for k in keys:
            if len(k) > LONG_RUN and (ids := self.now.pop(k, None)) is not None:
                self.size -= sys.getsizeof(k) + sys.getsizeof(ids) + 100

    def unknown(self, keys: set[str]) -> list[str]:
        """Those of `keys` that have to be made; the others are in `now` afterwards."""
        if self.size >= MAX_BYTES:
            self.older, self.now, self.size = self.now, {}, 0
        now, older, out, back = self.now, self.older, [], []
        for k in keys.difference(now):
            if k in older:
                now[k] = older[k]
                back.append(k)
            else:
                out.append(k)
        self.grown(back)
        return out


_made: dict[str, "BpeIds"] = {}


class BpeIds:
    """Ids of texts by the lower-casing word BPE file at `path` (see tests for the parity)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.table = _Table()

    @classmethod
    def of(cls, path: str) -> "BpeIds":
        """The worker's own instance (its tables outlive a task)."""
        if path not in _made:
            _made[path] = cls(path)
        return _made[path]

    def _encoded(self, text: str) -> bytes:
        """Ids of any text by the whole tokenizer."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn_words(self, new: list[str]) -> None:
        """Ids of words of the pattern, in lower-case Latin-1: merges of their UTF-8 bytes."""
        merge, known = self.tokenizer.model.tokenize, self.table.now
        for w in new:
            shown = w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(BYTE_SIGNS)
            ids = array("I", [t.id for t in merge(shown)])
            if sys.byteorder == "big":
                ids.byteswap()
            known[w] = ids.tobytes()

    def _learn(self, runs: set[str]) -> set[str]:
        """Ids of runs without white space: of a word, or of several words; those that are new."""
        words, several = [], {}
        new = self.table.unknown(runs)
        for r in new:
            if r.isalpha() and r.islower() and _latin(r):
                words.append(r)
            elif "<|" in r or not _latin(r):
                self.table.now[r] = self._encoded(r)
            else:
                several[r] = WORDS.findall(r.lower())
        known = self.table.now
        more = {w for parts in several.values() for w in parts}.difference(known, words)
        self._learn_words([*words, *more])
        for r, parts in several.items():
            known[r] = b"".join([known[w] for w in parts])
        self.table.grown({*new, *more})
        return {*new, *more}

    def _runs(self, text: str) -> list[str]:
        """What stands between white space; in plain texts full stops and commas stand alone too."""
        if any(c in text for c in ODD_SPACE):
            return SPACE.findall(text)
        if "<|" not in text and _latin(text):
            lower = text.lower()
            if not MARKS_TOGETHER.search(lower):
                lower = lower.replace(".", " . ").replace(",", " , ")
            return lower.split()
        return text.split()

    def encode_many(self, texts) -> Iterator[bytes]:
        """Ids of whole texts, four bytes each; some texts are split at a time."""
        held: list[list[str]] = []
        size = 0
        for t in texts:
            held.append(self._runs(t))
            size += len(t)
            if size >= CHARS_AT_ONCE:
                yield from self._joined(held)
                held, size = [], 0
        yield from self._joined(held)

    def _joined(self, split: list[list[str]]) -> Iterator[bytes]:
        new = self._learn(set().union(*split))
        get = self.table.now.__getitem__
        joined = [b"".join(map(get, runs)) for runs in split]
        self.table.forget_long(new)
        yield from joined

    def encode(self, text: str) -> bytes:
        return next(self.encode_many([text]))


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True
