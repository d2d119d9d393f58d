"""Unigram segmentation by Viterbi over a double-array trie of pieces.

Pieces and scores come from a SentencePiece model file.  A file whose scores are
merge ranks (a byte-pair model) gets log scores by rank, ``-log(rank + 2.7)``, up to a
constant, as piece frequencies fall by Zipf's law; the log scores of a unigram
file are taken as they are.

White space: a blank is the marker at the front of a piece, and every text that
is not empty gets one more at its front, which decoding drops.  A character
that no piece covers, the marker's own character among them, becomes its UTF-8
bytes as byte pieces, so decoding gives every text back exactly.

No piece has a marker behind another character (checked when a model is read), so a text is
segmented between blanks.  The units that a worker doesn't remember are segmented
together: the search walks the trie for all of them in step, position by
position; units over ``LONG_UNIT`` bytes are searched one by one.  Of
segmentations with equal scores the one with the longer last piece is taken.

Edge cases: a null or empty text has no pieces; runs of blanks, line ends and
texts without any blank are kept exactly; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import sys
from array import array
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capture_lake.llm.common import bounded_batches, clean_text, table

#: Bytes of units (with their ids) a worker remembers, and as many again that it has seen before those;
#: units of over LONG_UNIT bytes are not remembered.
MAX_BYTES = 64 * 1024 * 1024
#: Units searched in step at a time, and the longest of them in bytes.
STEP_UNITS = 8192
LONG_UNIT = 256
#: A character without a piece scores this much less than the least likely piece.
UNKNOWN_PENALTY = 10.0
MARKER = "▁"


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Trie:
    """A double array: from state s the byte c leads to t = base[s] + c + 1 if check[t] == s;
    value[t] is the piece that ends there, or -1."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray

    @classmethod
    def build(cls, pieces: dict[bytes, int]) -> "Trie":
        keys = sorted(pieces)
        size = 1 << 16
        base, check, value = [0] * size, [-1] * size, [-1] * size
        check[0] = 0
        first_free, several = 1, 0
        # (state, from, to, depth): keys[from:to] share their first `depth` bytes
        todo = [(0, 0, len(keys), 0)]
        for state, lo, hi, depth in todo:
            if len(keys[lo]) == depth:
                value[state] = pieces[keys[lo]]
                lo += 1
            children = []
            at = lo
            while at < hi:
                c, end = keys[at][depth], at
                while end < hi and keys[end][depth] == c:
                    end += 1
                children.append((c, at, end))
                at = end
            if not children:
                continue
            # an only child takes the first free place; several are looked for behind where many were tried in vain
            if len(children) == 1:
                while first_free < len(check) and check[first_free] >= 0:
                    first_free += 1
                b = first_free - children[0][0] - 1
                b = b if b >= 0 else several
            else:
                b = several
            tried = 0
            while True:
                while b + 257 >= len(check):
                    base += [0] * size
                    value += [-1] * size
                    check += [-1] * size
                if all(check[b + c + 1] < 0 for c, _, _ in children):
                    break
                b += 1
                tried += 1
            if tried > 50:
                several = b
            base[state] = b
            for c, start, end in children:
                check[b + c + 1] = state
                todo.append((b + c + 1, start, end, depth + 1))
        used = max(i for i, x in enumerate(check) if x >= 0) + 258
        cut = lambda x: np.array((x + [-1] * 258)[:used], np.int32)
        return cls(cut(base), cut(check), cut(value))


@dataclass
class Model:
    """Pieces as bytes (a blank for the marker), their log scores, ids of the byte pieces."""

    piece_bytes: list[bytes]
    scores: np.ndarray
    byte_ids: list[int]
    trie: Trie
    longest: int
    unknown: float

    @classmethod
    def read(cls, path: str) -> "Model":
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        scores = np.array([sp.get_score(i) for i in ids], float)
        byte_ids = [-1] * 256
        out, pieces = [b""] * len(ids), {}
        for i in ids:
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                out[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                out[i] = piece.replace(MARKER, " ").encode()
                pieces[out[i]] = i
        if min(byte_ids) < 0:
            raise ValueError("the model has no byte fallback")
        if any(b" " in p.lstrip(b" ") for p in pieces):
            raise ValueError("a piece has a marker behind another character")
        used = sorted(pieces.values())
        if all(scores[i] == round(scores[i]) for i in used):  # merge ranks
            rank = -scores
            scores = -np.log(np.maximum(rank, 0) + 2.7)
            scores -= math.log(sum(np.exp(scores[used])))
        return cls(out, scores, byte_ids, Trie.build(pieces), max(map(len, pieces)), float(scores[used].min()) - UNKNOWN_PENALTY)


def _char_length(first: int) -> int:
    return 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4


class Segmenter:
    """Segmentation of units (bytes without a blank behind another character) by one model."""

    def __init__(self, model: Model):
        self.m = model
        # ids (unsigned 16-bit) and scores by unit, and those of the units used before
        self.ids: dict[bytes, bytes] = {}
        self.scores: dict[bytes, float] = {}
        self.older: tuple[dict[bytes, bytes], dict[bytes, float]] = ({}, {})
        self.size = 0

    def one(self, unit: bytes) -> tuple[list[int], float]:
        """Ids and score of one unit."""
        m, n = self.m, len(unit)
        base, check, value, scores = m.trie.base, m.trie.check, m.trie.value, m.scores
        best, back = [-math.inf] * (n + 1), [(0, -1)] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            if best[i] == -math.inf:
                continue
            state, char_end, covered = 0, i + _char_length(unit[i]), False
            for j in range(i, min(n, i + m.longest)):
                nxt = int(base[state]) + unit[j] + 1
                if check[nxt] != state:
                    break
                state = nxt
                if value[state] >= 0:
                    covered |= j + 1 == char_end
                    score = best[i] + scores[value[state]]
                    if score > best[j + 1]:
                        best[j + 1], back[j + 1] = score, (i, int(value[state]))
            if not covered and best[i] + m.unknown > best[char_end]:
                best[char_end], back[char_end] = best[i] + m.unknown, (i, -1)
        ids: list[int] = []
        at = n
        while at:
            start, piece = back[at]
            ids += [piece] if piece >= 0 else [m.byte_ids[c] for c in reversed(unit[start:at])]
            at = start
        return ids[::-1], best[n]

    def many(self, units: list[bytes]) -> list[tuple[bytes, float]]:
        """Ids as bytes and score of units of at most LONG_UNIT bytes, all in step."""
        m, w = self.m, len(units)
        size = np.array([len(u) for u in units])
        longest = int(size.max(initial=0))
        text = np.zeros((longest + 1, w), np.int64)
        for k, u in enumerate(units):
            text[: len(u), k] = np.frombuffer(u, np.uint8)
        best = np.full((longest + 1, w), -np.inf)
        best[0] = 0.0
        start = np.zeros((longest + 1, w), np.int32)
        piece = np.full((longest + 1, w), -1, np.int32)
        base, check, value, scores = m.trie.base, m.trie.check, m.trie.value, m.scores
        chars = np.where(text < 0x80, 1, np.where(text < 0xE0, 2, np.where(text < 0xF0, 3, 4)))
        for i in range(longest):
            live = np.nonzero((best[i] > -np.inf) & (size > i))[0]
            if not len(live):
                continue
            rows, state = live, np.zeros(len(live), np.int64)
            covered = np.zeros(w, bool)
            for j in range(i, min(longest, i + m.longest)):
                nxt = base[state] + text[j, rows] + 1
                ok = (check[nxt] == state) & (size[rows] > j)
                rows, state = rows[ok], nxt[ok]
                if not len(rows):
                    break
                v = value[state]
                ends = v >= 0
                if ends.any():
                    r, v = rows[ends], v[ends]
                    covered[r[chars[i, r] == j + 1 - i]] = True
                    score = best[i, r] + scores[v]
                    better = score > best[j + 1, r]
                    r, v = r[better], v[better]
                    best[j + 1, r], start[j + 1, r], piece[j + 1, r] = score[better], i, v
            bare = live[~covered[live]]
            if len(bare):
                end = i + chars[i, bare]
                score = best[i, bare] + m.unknown
                better = score > best[end, bare]
                bare, end = bare[better], end[better]
                best[end, bare], start[end, bare], piece[end, bare] = score[better], i, -1
        # back from the ends, a piece of every unit a round
        at, lanes, found = size.copy(), np.arange(w), []
        while len(lanes):
            lanes = lanes[at[lanes] > 0]
            if not len(lanes):
                break
            found.append((lanes, piece[at[lanes], lanes], start[at[lanes], lanes], at[lanes]))
            at[lanes] = start[at[lanes], lanes]
        # one row of ids per unit, its last piece in the last column
        rounds = len(found)
        grid, count, bare = np.zeros((w, rounds), np.uint16), np.zeros(w, np.int64), np.zeros(w, bool)
        for r, (lanes, pieces, _, _) in enumerate(found):
            grid[lanes, rounds - 1 - r] = pieces
            count[lanes] = r + 1
            bare[lanes[pieces < 0]] = True
        raw = grid.tobytes()
        out = [raw[2 * (k * rounds + rounds - n) : 2 * (k + 1) * rounds] for k, n in enumerate(count.tolist())]
        spelt: dict[int, array] = {k: array("H") for k in np.nonzero(bare)[0].tolist()}
        for lanes, pieces, starts, ends in reversed(found):  # characters without a piece, as bytes
            some = bare[lanes]
            for k, p, a, b in zip(*(x[some].tolist() for x in (lanes, pieces, starts, ends))):
                spelt[k].extend([p] if p >= 0 else [m.byte_ids[c] for c in units[k][a:b]])
        for k, ids in spelt.items():
            out[k] = ids.tobytes()
        return list(zip(out, best[size, np.arange(w)].tolist()))

    def remember(self, units: set[bytes]) -> list[bytes]:
        """Segment the units that are not known yet; the long ones among them."""
        if self.size > MAX_BYTES:  # memory stays bounded; units in use come back from the older ones
            self.older, self.ids, self.scores, self.size = (self.ids, self.scores), {}, {}, 0
        old_ids, old_scores = self.older
        new, seen = [], list(units.difference(self.ids))
        for u in seen:
            if u in old_ids:
                self.ids[u], self.scores[u] = old_ids[u], old_scores[u]
            else:
                new.append(u)
        new.sort(key=len)
        short = [u for u in new if len(u) <= LONG_UNIT]
        for at in range(0, len(short), STEP_UNITS):
            part = short[at : at + STEP_UNITS]
            for u, (ids, score) in zip(part, self.many(part)):
                self.ids[u], self.scores[u] = ids, score
        for u in new[len(short) :]:
            ids, score = self.one(u)
            self.ids[u], self.scores[u] = array("H", ids).tobytes(), score
        size = sys.getsizeof
        self.size += sum(size(u) + size(self.ids[u]) + 250 for u in seen)  # two places and a number besides
        return [u for u in new[len(short):]]

    def forget(self, units: list[bytes]) -> None:
        for u in units:
            self.size -= sys.getsizeof(u) + sys.getsizeof(self.ids.pop(u)) + 250
            del self.scores[u]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, float]]:
        """(ids, score) of every text; at most as many units are new as the texts have."""
        split = [units_of(t) for t in texts]
        long = self.remember(set().union(*split))
        ids, score = self.ids.__getitem__, self.scores.__getitem__
        out = [(np.frombuffer(b"".join(map(ids, units)), np.uint16), math.fsum(map(score, units))) for units in split]
        self.forget(long)
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: bytes of byte pieces, blanks for markers, without the first blank."""
        b = self.m.piece_bytes
        text = b"".join([b[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def units_of(text: str) -> list[bytes]:
    """Runs of blanks with what follows them, after one more blank at the front."""
    if not text:
        return []
    data = b" " + text.encode("utf-8", "surrogatepass")
    if b"  " in data or data.endswith(b" "):
        return re.findall(rb" +[^ ]*", data)
    return [b" " + w for w in data[1:].split(b" ")]


_segmenters: dict = {}


def segmentation(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text, ids, score, round_trip): the pieces of every whole text, the sum of their log
    scores, and whether decoding them gave the text back."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(Model.read(path or model_path()))

    @F.pandas_udf("ids binary, score double, round_trip boolean")
    def cut(text: pd.Series) -> pd.DataFrame:
        seg = _segmenters.setdefault(path, Segmenter(shared.value))
        ids_, scores, same = [], [], []
        for at in range(0, len(text), 200):
            part = text.iloc[at : at + 200].tolist()
            for t, (ids, score) in zip(part, seg.encode(part)):
                ids_.append(ids.astype("<u2").tobytes())
                scores.append(score)
                same.append(seg.decode(ids) == t)
        return pd.DataFrame({"ids": ids_, "score": scores, "round_trip": same})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), clean_text().alias("text"), cut(clean_text()).alias("cut"))
    return rows.select("doc_id", "text", "cut.ids", "cut.score", "cut.round_trip")


def decoded(ids: str, path: str | None, spark):
    """Column with the text of a column of ids."""
    shared = spark.sparkContext.broadcast(Model.read(path or model_path()))

    @F.pandas_udf("string")
    def join(col: pd.Series) -> pd.Series:
        seg = _segmenters.setdefault(path, Segmenter(shared.value))
        return pd.Series([seg.decode(np.frombuffer(x, "<u2")) for x in col])

    return join(F.col(ids))


def op8_unigram_segmentation(spark, sf_dir: str) -> DataFrame:
    """Per document: number of pieces, checksum of the ids (unsigned little-endian 16 bit), score,
    and whether decoding gives the text back."""
    cut = segmentation(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", (F.length("ids") / 2).cast("long").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"), "score", "round_trip")
