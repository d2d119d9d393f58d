"""Collocations by stripes: every prefix keys an associative counter of its next words.

The stripe of a prefix (up to four words, or none) maps next words to counts, with one more
entry, the empty word, for the prefix's places that no counted word follows.  A task
makes the stripes of all lengths in one pass over its texts and adds them up in a bounded
table; stripes of one prefix are merged elementwise after one shuffle.  A merged stripe gives
three things: its entries of at least `least` are the extensions and their counts, the sum of
all its entries is the prefix's own count, and its largest entry says whether an extension to
the right subsumes the prefix (the same entry, read as a phrase without its first word, says
so for the left).

Most phrases are rare, and a stripe need not hold them.  So phrases are first counted by
bucket: the hash of a phrase is its bucket, tasks send (bucket, count) of a few bytes, and
a bucket of at least `least` is heavy.  A phrase in no heavy bucket is rare, a frequent one is
always in a heavy bucket, and so are, by chance, some rare ones: they are counted in the
stripes and dropped by their count.  Phrases of three and more words are only counted where the
shorter ones in them are heavy.  The heavy buckets are bitmaps of a fixed size, sent compressed, so
what goes to the tasks is bounded, and the counts are exact at every size.

On a large corpus most phrases are frequent, so there are nearly as many entries as places.  Entries
are therefore kept in matrices of word numbers, added up by sorting; the words themselves are kept
once a table.  Hashes only order entries: what is added up is equal word by word.

Stripes travel in parcels, one per task and part of the prefixes (by hash; the empty prefix's stripe is
cut by the next word's), compressed, with the words that they hold; there are as many parts as the heavy
buckets ask for.

An extension by several words that subsumes a phrase has an extension by one word in it that
does so too (it occurs at least as often), so one word to each side is enough.

Edge cases: a null text has no words, a null lang counts as `und`; empty and very long
texts and words, repeated rows and other columns need no care (only `text` and `lang` are read,
whole; every row counts); phrases with equal scores and counts are ordered by their bytes; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capture_lake.llm.common import bounded_batches, clean_text, stored, table

MOST_WORDS = 5
#: Characters of text that are encoded at once.
CHUNK_CHARS = 12 * 1024 * 1024
#: Phrase places, and entries of stripes, that a task adds up before it sends them.
PLACES = 8_000_000
ENTRIES = 500_000
#: Heavy buckets per part of the prefixes, and least number of parts.
PART_BUCKETS = 20_000
LEAST_PARTS = 64
#: Bits of a bitmap of heavy buckets, and buckets that are counted together by one key of the shuffle.
BITMAP_BITS = 1 << 27
PIECE_BITS = 16
#: Entries of merged stripes held back for one Arrow batch.
OUT_ENTRIES = 100_000
#: Entries of a part's parcels that are added up at once, at least.
MERGED = 1_000_000
REST = ""
#: In entries of stripes: no word in this place of the prefix; the empty word.
NONE, NO_WORD = -1, -2

_SEPARATORS = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d\x09", b"\n" * 10 + b" ")
_CUT = re.compile("[.,;:!?\x0a-\x0d]")
_MIX = np.uint64(0x9E3779B97F4A7C15)

STRIPE = pa.schema([("lang", pa.string()), ("prefix", pa.string()), ("part", pa.int32()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
PARCEL = pa.schema([("langs", pa.list_(pa.string())), ("words", pa.list_(pa.large_binary())), ("at", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])
BUCKETS_DDL = "level int, piece int, at binary, n binary"
STRIPE_DDL = "lang string, prefix string, part int, words array<string>, counts array<bigint>"


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def extend_hash(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase from its prefix's hash and its last word's."""
    h = (prefix ^ (prefix >> np.uint64(29))) * _MIX + word
    h ^= h >> np.uint64(32)
    return h * _MIX


def lang_hash(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8"), 7))


def _bit(h: np.ndarray, bits: int) -> np.ndarray:
    """The place of a hash in a bitmap of `bits` bits (a power of two)."""
    return h >> np.uint64(64 - (bits.bit_length() - 1))


def has_bits(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = _bit(h, len(bitmap) * 8)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def encode(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """(distinct words, ids of the running words with -1 between pieces)."""
    joined = "\n".join(texts).encode("utf-8").lower().translate(_SEPARATORS)
    running = pc.split_pattern(pa.array([joined.replace(b"\n", b" \n ")], pa.large_binary()), " ").flatten().dictionary_encode()
    words, ids = running.dictionary.to_pylist(), running.indices.to_numpy()
    number, known = np.empty(len(words), np.int64), []
    for i, w in enumerate(words):
        number[i] = -1 if w == b"\n" else -2 if w == b"" else len(known)
        if number[i] >= 0:
            known.append(w)
    ids = number[ids]
    return known, ids[ids != -2]


def slices(text: str, most: int) -> Iterator[str]:
    """A very long text cut between pieces, so no more than a chunk (or one piece) is taken at once."""
    at = 0
    while len(text) - at > most:
        cut = _CUT.search(text, at + most)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:] if at else text


def ahead(mask: np.ndarray, t: int) -> np.ndarray:
    """The mask as seen from `t` places before."""
    out = np.zeros(len(mask), bool)
    out[: max(0, len(mask) - t)] = mask[t:]
    return out


class Chunk:
    """The words of some texts of one language, and the hashes of the phrases that start at each."""

    def __init__(self, lang: str, texts: list[str]):
        self.words, self.ids = encode(texts)
        n = len(self.ids)
        self.hashes = np.fromiter(map(word_hash, self.words), np.uint64, len(self.words))
        running = np.where(self.ids >= 0, self.hashes[np.maximum(self.ids, 0)] if len(self.words) else np.uint64(0), np.uint64(0))
        self.running = np.concatenate((running, np.zeros(MOST_WORDS, np.uint64)))
        self.padded = np.concatenate((self.ids, np.full(MOST_WORDS, -1)))
        self.n, self.seed = n, lang_hash(lang)

    def phrases(self, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(words, which starts have a whole phrase of so many words, hashes)."""
        whole, h = np.ones(self.n, bool), np.full(self.n, self.seed)
        for t in range(most):
            whole = whole & (self.padded[t : t + self.n] >= 0)
            h = extend_hash(h, self.running[t : t + self.n])
            yield t + 1, whole, h

    def heavy(self, bitmaps: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        """Per number of words, the starts of phrases in heavy buckets all of whose shorter ones are too."""
        out: dict[int, np.ndarray] = {}
        for j, whole, h in self.phrases(max(bitmaps, default=0)):
            if j in bitmaps:
                mask = whole.copy()
                if j - 1 in out:
                    mask &= out[j - 1] & ahead(out[j - 1], 1)
                at = np.nonzero(mask)[0]
                mask[at] = has_bits(bitmaps[j], h[at])
                out[j] = mask
        return out


def bucket_counts(chunks: Iterator[Chunk], levels: list[int], known: dict[int, np.ndarray], least: int, bits: int, places: int) -> Iterator[pa.RecordBatch]:
    """(level, piece, places in the piece, counts): phrases by bucket, added up over many chunks.

    A count is cut at `least`, which is enough to tell that a bucket is heavy."""
    waiting: dict[int, list[np.ndarray]] = {j: [] for j in levels}
    held = 0
    shift = np.uint64(64 - (bits.bit_length() - 1))
    width = min(PIECE_BITS, bits.bit_length() - 1)
    kind = np.uint8 if least < 256 else np.uint32

    def flush() -> Iterator[pa.RecordBatch]:
        for j, parts in waiting.items():
            if not parts:
                continue
            buckets, counts = np.unique(np.concatenate(parts), return_counts=True)
            piece = buckets >> np.uint32(width)
            names, first = np.unique(piece, return_index=True)
            ends = np.append(first[1:], len(piece))
            low = (buckets & np.uint32((1 << width) - 1)).astype(np.uint16)
            counts = np.minimum(counts, least).astype(kind)
            yield pa.RecordBatch.from_pydict({
                "level": pa.array([j] * len(names), pa.int32()), "piece": pa.array(names.astype(np.int32)),
                "at": pa.array([low[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()), "n": pa.array([counts[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
            })

    for chunk in chunks:
        before = chunk.heavy(known)
        for j, whole, h in chunk.phrases(max(levels)):
            if j not in waiting:
                continue
            shorter = max((k for k in before if k < j), default=None)
            if shorter is not None:  # every shorter phrase in it is heavy
                ok = before[shorter]
                whole = whole.copy()
                for t in range(j - shorter + 1):
                    whole &= ahead(ok, t)
            found = (h[whole] >> shift).astype(np.uint32)
            waiting[j].append(found)
            held += len(found)
        if held >= places:
            yield from flush()
            waiting, held = {j: [] for j in levels}, 0
    yield from flush()


def heavy_pieces(batches: Iterator[pa.RecordBatch], least: int, width: int) -> Iterator[pa.RecordBatch]:
    """The heavy buckets of each (level, piece) that has some, as compressed bits; rows come sorted by level and piece."""
    kind = np.uint8 if least < 256 else np.uint32
    key, total = None, None

    def close() -> Iterator[pa.RecordBatch]:
        heavy = total >= least
        if heavy.any():
            bits = zlib.compress(np.packbits(heavy, bitorder="little").tobytes(), 1)
            yield pa.RecordBatch.from_pydict({"level": pa.array([key[0]], pa.int32()), "piece": pa.array([key[1]], pa.int32()), "bits": pa.array([bits], pa.binary())})

    for b in batches:
        for level, piece, at, n in zip(*(b.column(i).to_pylist() for i in range(4))):
            if (level, piece) != key:
                if key is not None:
                    yield from close()
                key, total = (level, piece), np.zeros(1 << width, np.int64)
            total[np.frombuffer(at, np.uint16)] += np.frombuffer(n, kind)
    if key is not None:
        yield from close()


def chunks_of(batches: Iterator[pa.RecordBatch], chunk_chars: int) -> Iterator[tuple[str, Chunk]]:
    """(lang, chunk) of batches of (lang, text)."""
    waiting: dict[str, list[str]] = {}
    size = 0
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for part in slices(text, chunk_chars):
                waiting.setdefault(lang, []).append(part)
                size += len(part)
                if size >= chunk_chars:
                    yield from ((x, Chunk(x, texts)) for x, texts in waiting.items())
                    waiting, size = {}, 0
    yield from ((x, Chunk(x, texts)) for x, texts in waiting.items())


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a place of each distinct key, which of them each place has, how often each occurs); keys are not negative."""
    bits = len(keys).bit_length()
    if int(keys.max(initial=0)) >> (63 - bits) == 0:  # key and place fit one word, and plain sorts are the fastest
        order = np.sort((keys << bits) | np.arange(len(keys)))
        held, order = order >> bits, order & ((1 << bits) - 1)
    else:
        order = np.argsort(keys)
        held = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = held[1:] != held[:-1]
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return order[first], which, np.diff(first, append=len(keys))


def runs(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(an order in which equal columns of a matrix stand together, where each run of them begins).

    They are ordered by hash; should two that differ have the same hash, by what they hold."""
    h = np.zeros(columns.shape[1], np.uint64)
    for row in columns:
        h = extend_hash(h, row.astype(np.uint64))
    order = np.argsort(h)

    def differ() -> np.ndarray:
        out = np.zeros(max(0, len(order) - 1), bool)
        for row in columns:
            out |= np.diff(row[order]) != 0
        return out

    new = differ()
    if (new & (np.diff(h[order]) == 0)).any():
        order = np.lexsort(columns)
        new = differ()
    return order, np.flatnonzero(np.concatenate((np.ones(min(1, len(order)), bool), new)))


def summed(entries: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each distinct entry once, with the sum of its counts."""
    order, first = runs(entries)
    return entries[:, order[first]], np.add.reduceat(counts[order], first) if len(first) else counts


def stripe_entries(chunk: Chunk, bitmaps: dict[int, np.ndarray], most: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, the entries of a chunk's stripes by the words' numbers, each once, their counts).

    An entry is a column of a matrix: the language (0 here), the words of the prefix (NONE where it
    has no more), the next word (NO_WORD for the empty one)."""
    heavy = chunk.heavy(bitmaps)
    m = len(chunk.words) + 1
    starts = np.flatnonzero(chunk.ids >= 0)
    number = np.zeros(len(starts), np.int64)  # of the prefix that begins at each start
    found, times = [np.zeros((MOST_WORDS + 1, 0), np.int32)], [np.zeros(0, np.int64)]
    for j in range(1, most + 1):
        if not len(starts):
            break
        longer = heavy[j][starts]
        last = np.where(longer, chunk.padded[starts + j - 1], m - 1)
        at, which, counts = grouped(number * m + last)
        out = np.full((MOST_WORDS + 1, len(at)), NONE, np.int32)
        out[0] = 0
        for t in range(j - 1):
            out[t + 1] = chunk.padded[starts[at] + t]
        out[-1] = np.where(longer[at], last[at], NO_WORD)
        found.append(out)
        times.append(counts)
        starts, number = starts[longer], which[longer]
    entries = np.concatenate(found, axis=1)
    used = np.zeros(len(chunk.words) + 2, bool)
    used[entries[1:]] = True
    used = np.flatnonzero(used[:-2])
    words = pa.array([chunk.words[i] for i in used.tolist()], pa.large_binary())
    number = by_number(len(chunk.words))
    number[used] = np.arange(len(used))
    entries[1:] = number[entries[1:]]
    return words, entries, np.concatenate(times)


def by_number(words: np.ndarray | int) -> np.ndarray:
    """New numbers of words by their old ones; NO_WORD and NONE, which count from the end, stay as they are."""
    given = np.full(words, NONE) if isinstance(words, int) else words
    return np.concatenate((given, [NO_WORD, NONE])).astype(np.int32)


class Table:
    """Entries of stripes added up, with the languages and words that they hold by number."""

    def __init__(self) -> None:
        self.langs, self.words = pa.array([], pa.string()), pa.array([], pa.large_binary())
        self.entries, self.counts = np.zeros((MOST_WORDS + 1, 0), np.int32), np.zeros(0, np.int64)
        self.waiting: list[tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, langs: pa.Array, words: pa.Array, entries: np.ndarray, counts: np.ndarray) -> None:
        """Entries, each once, whose languages and words are numbered by the arrays given."""
        self.waiting.append((langs, words, entries, counts))
        self.size += len(counts)

    def add_up(self) -> None:
        if not self.waiting:
            return
        alone = len(self.waiting) == 1 and not len(self.counts)
        waiting, self.waiting = [(self.langs, self.words, self.entries, self.counts), *self.waiting], []
        langs, words = (pa.concat_arrays([x[i] for x in waiting]).dictionary_encode() for i in (0, 1))
        self.langs, self.words = langs.dictionary, words.dictionary
        lang, word = langs.indices.to_numpy(), words.indices.to_numpy()
        numbered = []
        for own_langs, own_words, entries, _ in waiting:
            numbered.append(np.concatenate((lang[: len(own_langs)][entries[:1]], by_number(word[: len(own_words)])[entries[1:]])))
            lang, word = lang[len(own_langs) :], word[len(own_words) :]
        self.entries, self.counts = np.concatenate(numbered, axis=1), np.concatenate([x[3] for x in waiting])
        if not alone:
            self.entries, self.counts = summed(self.entries, self.counts)
        self.size = len(self.counts)


def part_of(table: Table, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(the part of each entry's stripe, a hash of its prefix); the empty prefix's stripe is cut by the next word."""
    entries, words = table.entries, np.zeros(len(table.words) + 2, np.uint64)
    words[: len(table.words)] = np.fromiter(map(word_hash, table.words.to_pylist()), np.uint64, len(table.words))
    h = np.array([lang_hash(x) for x in table.langs.to_pylist()], np.uint64)[entries[0]]
    for row in entries[1:-1]:
        h = np.where(row >= 0, extend_hash(h, words[row]), h)
    h = np.where(entries[1] < 0, extend_hash(h, words[entries[-1]]), h)
    return ((h >> np.uint64(33)) % np.uint64(parts)).astype(np.int32), h


def parcels(table: Table, parts: int) -> Iterator[pa.RecordBatch]:
    """The stripes as (part, compressed entries with the words they hold), prefix by prefix."""
    table.add_up()
    part, h = part_of(table, parts)
    order = np.argsort((part.astype(np.uint64) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF)))
    entries, counts, part = table.entries[:, order], table.counts[order], part[order]
    table.entries, table.counts = entries, counts  # not held twice
    del order, h
    used, number = np.zeros(len(table.words) + 2, bool), by_number(len(table.words))
    edges = np.flatnonzero(np.concatenate((np.ones(min(1, len(part)), bool), np.diff(part) != 0)))
    for lo, hi in zip(edges.tolist(), [*edges[1:].tolist(), len(part)]):
        some = entries[:, lo:hi]
        lang, lang_at = np.unique(some[0], return_inverse=True)
        used[some[1:]] = True
        word = np.flatnonzero(used[:-2])
        used[word] = False
        number[word] = np.arange(len(word))
        at = np.concatenate((lang_at.reshape(1, -1).astype(np.int32), number[some[1:]])).ravel()
        held = (table.langs.take(pa.array(lang)), table.words.take(pa.array(word)), pa.array(at), pa.array(counts[lo:hi]))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, PARCEL, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in held], schema=PARCEL))
        yield pa.RecordBatch.from_pydict({"part": pa.array([part[lo]], pa.int32()), "stripes": pa.array([sink.getvalue().to_pybytes()], pa.binary())})


def merged_part(part: int, table: Table, least: int) -> Iterator[pa.RecordBatch]:
    """The stripes of a part, once all its parcels are in the table."""
    table.add_up()
    order, first = runs(table.entries[:-1])
    if not len(order):
        return
    entries, counts = table.entries[:, order], table.counts[order]
    kept = (counts >= least) & (entries[-1] >= 0)
    rest = np.add.reduceat(np.where(kept, 0, counts), first)
    many = np.add.reduceat(kept, first, dtype=np.int64)
    stay = (many > 0) | (entries[1, first] < 0)
    ends = np.cumsum(many[stay] + 1)
    if not len(ends):
        return
    word, count = np.full(ends[-1], len(table.words), np.int64), np.empty(ends[-1], np.int64)
    listed = np.ones(ends[-1], bool)
    listed[ends - 1] = False  # the empty word comes last
    word[listed], count[listed] = entries[-1, kept], counts[kept]
    count[ends - 1] = rest[stay]
    names, (empty, space) = table.words.cast(pa.large_string()), pa.array(["", " "], pa.large_string())
    more = pa.concat_arrays([pc.binary_join_element_wise(empty, names, space), pa.array([""], pa.large_string())])
    names = pa.concat_arrays([names, pa.array([REST], pa.large_string())])
    prefix = entries[:-1, first[stay]]
    places = [(more if t else names).take(pa.array(np.where(row < 0, len(table.words), row))) for t, row in enumerate(prefix[1:])]
    offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
    out = pa.RecordBatch.from_arrays([
        table.langs.take(pa.array(prefix[0])), pc.binary_join_element_wise(*places, empty).cast(pa.string()), pa.array(np.full(len(ends), part, np.int32)),
        pa.ListArray.from_arrays(offsets, names.take(pa.array(word)).cast(pa.string())), pa.ListArray.from_arrays(offsets, pa.array(count)),
    ], schema=STRIPE)
    at = 0
    while at < len(ends):
        before = int(ends[at - 1]) if at else 0
        until = max(at + 1, int(np.searchsorted(ends, before + OUT_ENTRIES, "right")))
        yield out.slice(at, until - at)
        at = until


def merge_stripes(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Elementwise sums of the stripes that share a prefix; parcels come sorted by part, a part is merged at a time.

    Entries below `least` go into the empty word's, so the sum of a stripe stays its prefix's count;
    stripes that are left with no other are of no use and go (the empty prefix's stay)."""
    part, table = None, Table()
    for b in batches:
        for here, parcel in zip(b.column(0).to_pylist(), b.column(1)):
            if here != part:
                yield from merged_part(part, table, least)
                part, table = here, Table()
            langs, words, at, counts = (c[0].values for c in pa.ipc.open_stream(parcel.as_buffer()).read_all().combine_chunks().columns)
            table.add(langs, words, at.to_numpy().reshape(MOST_WORDS + 1, -1), counts.to_numpy())
            if table.size >= max(MERGED, 2 * len(table.counts)):
                table.add_up()
    yield from merged_part(part, table, least)


#: Pieces of bitmaps as (piece, compressed bits), per number of words.
Packed = dict[int, list[tuple[int, bytes]]]
_UNPACKED: list = [None, None]


def unpacked(packed: Packed, bits: int) -> dict[int, np.ndarray]:
    """The bitmaps; a worker keeps those it unpacked last."""
    if _UNPACKED[0] is not packed:
        size = (1 << min(PIECE_BITS, bits.bit_length() - 1)) // 8
        out = {j: np.zeros(bits // 8, np.uint8) for j in packed}
        for j, pieces in packed.items():
            for piece, held in pieces:
                out[j][piece * size : (piece + 1) * size] = np.frombuffer(zlib.decompress(held), np.uint8)
        _UNPACKED[:] = [packed, out]
    return _UNPACKED[1]


def heavy_buckets(docs: DataFrame, levels: list[int], known: Packed, least: int, bits: int, chunk_chars: int, places: int) -> Packed:
    """The bitmap of heavy buckets per number of words; `known` are those of shorter phrases."""
    shared = docs.sparkSession.sparkContext.broadcast(known)
    width = min(PIECE_BITS, bits.bit_length() - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from bucket_counts((c for _, c in chunks_of(batches, chunk_chars)), levels, unpacked(shared.value, bits), least, bits, places)

    counted = docs.select("lang", "text").mapInArrow(count, BUCKETS_DDL)
    pieces = counted.repartition("level", "piece").sortWithinPartitions("level", "piece").mapInArrow(
        lambda batches: heavy_pieces(batches, least, width), "level int, piece int, bits binary")
    out: Packed = {j: [] for j in levels}
    for r in stored(pieces).toLocalIterator():  # as many rows as there are pieces at most, each of one size at most
        out[r["level"]].append((r["piece"], bytes(r["bits"])))
    shared.unpersist()
    return out


def stripes(docs: DataFrame, heavy: Packed, least: int, most_words: int, bits: int, chunk_chars: int, most_entries: int) -> DataFrame:
    """The merged stripes of all prefixes, stored: (lang, prefix, part, words, counts)."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)
    buckets = sum(np.unpackbits(np.frombuffer(zlib.decompress(held), np.uint8)).sum() for pieces in heavy.values() for _, held in pieces)
    parts = max(LEAST_PARTS, int(buckets) // PART_BUCKETS)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table()
        for lang, chunk in chunks_of(batches, chunk_chars):
            table.add(pa.array([lang], pa.string()), *stripe_entries(chunk, unpacked(shared.value, bits), most_words))
            if table.size >= most_entries:
                table.add_up()
            if table.size >= most_entries:
                yield from parcels(table, parts)
                table = Table()
        yield from parcels(table, parts)

    made = docs.select("lang", "text").mapInArrow(make, "part int, stripes binary")
    return stored(made.repartition("part").sortWithinPartitions("part").mapInArrow(lambda batches: merge_stripes(batches, least), STRIPE_DDL))


def entries(merged: DataFrame) -> DataFrame:
    """(lang, prefix, word, f): the frequent extensions of merged stripes."""
    each = F.explode(F.arrays_zip("words", "counts")).alias("e")
    rows = merged.select("lang", "prefix", each).where(F.col("e.words") != REST)
    return rows.select("lang", "prefix", F.col("e.words").alias("word"), F.col("e.counts").alias("f"))


def phrase_of(prefix: Column, word: Column) -> Column:
    return F.when(prefix == "", word).otherwise(F.concat(prefix, F.lit(" "), word))


def collocations(docs: DataFrame, least: int = 100, most_words: int = MOST_WORDS, subsumed_percent: int = 100, bitmap_bits: int = BITMAP_BITS,
                 chunk_chars: int = CHUNK_CHARS, places: int = PLACES, most_entries: int = ENTRIES) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases that are candidates and not subsumed.

    `docs`: lang and text without nulls; phrases have two to `most_words` (at most MOST_WORDS) words.  A
    phrase is dropped if a longer candidate around it has at least `subsumed_percent` percent of its count."""
    bounded_batches(docs.sparkSession)
    heavy: Packed = {}
    for levels in ([1, 2], [3], [4, 5]):
        levels = [j for j in levels if j <= most_words]
        if levels:
            heavy |= heavy_buckets(docs, levels, heavy, least, bitmap_bits, chunk_chars, places)
    merged = stripes(docs, heavy, least, most_words, bitmap_bits, chunk_chars, most_entries)
    total = F.aggregate("counts", F.lit(0).cast("bigint"), lambda x, y: x + y)
    n = merged.where("prefix = ''").groupBy("lang").agg(F.sum(total).alias("n"))
    # prefix totals and right maxima come from the prefix's own stripe, left maxima from its entries' phrases
    widest = F.array_max(F.transform(F.arrays_zip("words", "counts"), lambda e: F.when(e["words"] != REST, e["counts"]).otherwise(0)))
    heads = merged.where("prefix <> ''").select("lang", F.col("prefix").alias("phrase"), total.alias("total"), widest.alias("right"))
    phrase = phrase_of(F.col("prefix"), F.col("word"))
    found = stored(entries(merged).select("lang", phrase.alias("phrase"), F.col("f").alias("a")).withColumn("words", F.size(F.split("phrase", " "))))
    longer = found.where("words > 1").select("lang", F.expr("substring(phrase, locate(' ', phrase) + 1)").alias("phrase"), F.col("a").alias("left"))
    left = longer.groupBy("lang", "phrase").agg(F.max("left").alias("left"))
    candidates = found.where("words > 1")
    subsumed = F.greatest(F.coalesce("left", F.lit(0)), F.coalesce("right", F.lit(0))).cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * subsumed_percent
    kept = candidates.join(left, ["lang", "phrase"], "left").join(heads.drop("total"), ["lang", "phrase"], "left")
    kept = kept.where((F.greatest(F.coalesce("left", F.lit(0)), F.coalesce("right", F.lit(0))) < least) | ~subsumed).select("lang", "phrase", "a", "words")
    # every cut: the first part's count is the total of its stripe, the rest's is an entry
    at = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cut = kept.select("lang", "phrase", "a", at)
    cut = cut.withColumn("first", F.expr("array_join(slice(split(phrase, ' '), 1, k), ' ')"))
    cut = cut.withColumn("last", F.expr("substring(phrase, length(first) + 2)"))
    firsts = heads.select("lang", F.col("phrase").alias("first"), F.col("total").alias("l"))
    lasts = found.select("lang", F.col("phrase").alias("last"), F.col("a").alias("r"))
    cut = cut.join(firsts, ["lang", "first"]).join(lasts, ["lang", "last"]).join(n, "lang")
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * (wide("a") * wide("n")).cast("decimal(34,0)"), (wide("l") * wide("r")).cast("decimal(38,0)"))
    cut = cut.withColumn("score", score.cast("bigint"))
    lowest = cut.groupBy("lang", "phrase").agg(F.min_by(F.struct("a", "l", "r", "n", "score"), F.struct("score", "k")).alias("c"))
    return lowest.select("lang", "phrase", "c.*")


def best_collocations(docs: DataFrame, first: int = 2000, **how) -> DataFrame:
    """Each language's `first` collocations by score, count and bytes, with their rank."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = collocations(docs, **how).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.coalesce("lang", F.lit("und")).alias("lang"), clean_text().alias("text"))
    return best_collocations(docs)


ORACLE = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM pieces
), grams AS (
  SELECT lang, m, unnest(list_transform(generate_series(1, len(ws) - m + 1), lambda i: array_to_string(ws[i : i + m - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE len(ws) >= m
), f AS (
  SELECT lang, phrase, m, count(*) AS a FROM grams GROUP BY ALL
), n AS (
  SELECT lang, sum(a)::HUGEINT AS n FROM f WHERE m = 1 GROUP BY lang
), c AS (SELECT * FROM f WHERE a >= 100 AND m >= 2),
drops AS (
  SELECT DISTINCT lang, part AS phrase, a FROM (
    SELECT lang, a, unnest([array_to_string(string_split(phrase, ' ')[1 : m - 1], ' '), array_to_string(string_split(phrase, ' ')[2 : m], ' ')]) AS part FROM c)
), kept AS (
  SELECT c.* FROM c WHERE NOT EXISTS (SELECT 1 FROM drops d WHERE d.lang = c.lang AND d.phrase = c.phrase AND d.a >= c.a)
), cuts AS (
  SELECT lang, phrase, a, k, array_to_string(string_split(phrase, ' ')[1 : k], ' ') AS p1, array_to_string(string_split(phrase, ' ')[k + 1 : m], ' ') AS p2
  FROM (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM kept)
), scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, k, x.a AS l, y.a AS r, n.n,
         (1000::HUGEINT * cuts.a * n.n) // (x.a::HUGEINT * y.a) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = p1 JOIN f y ON y.lang = cuts.lang AND y.phrase = p2 JOIN n ON n.lang = cuts.lang
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""
