"""Best-fit packing improved by swap-based local search.

Whole documents (ids plus a closing id 0) go into sequences of at most
``CAPACITY`` tokens; only longer ones are cut, into full pieces and a rest.
Pieces are dealt evenly into groups of about ``GROUP`` pieces, and each group is
packed by itself, so no task holds more than one group; a group ends with at
most a sequence or so more than one packing of everything would need.

In a group, best-fit decreasing gives the first packing.  Then the emptiest bin
gives its documents away: a document moves into another underfull bin, is
exchanged for a smaller one, or two documents are exchanged for one (either way
round).  A step is taken only if it increases the sum of squared fills, and
steps go on until the bin is empty or none is left.

Edge cases: a null or empty text is the closing id alone; repeated rows are
packed as often as they occur; a null doc_id is kept; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capture_lake.llm.common import bounded_batches, clean_text, stored, table
from capture_lake.llm.tokens import BpeIds

CAPACITY = 2048
END_ID = 0
#: Pieces packed together by one task.
GROUP = 8192
PIECES = "doc_id string, piece int, start long, length long, ids_crc32 long"


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def cut_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the documents' ids in pieces of at most `capacity`."""
    bounded_batches(docs.sparkSession)
    end = int(END_ID).to_bytes(4, "little")

    @F.pandas_udf("total long, crcs array<long>")
    def cut(text: pd.Series) -> pd.DataFrame:
        total, crcs = [], []
        for ids in BpeIds.of(tokenizer_path).encode_many(text):
            ids += end
            total.append(len(ids) // 4)
            crcs.append([zlib.crc32(ids[at : at + 4 * capacity]) for at in range(0, len(ids), 4 * capacity)])
        return pd.DataFrame({"total": total, "crcs": crcs})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), cut(clean_text()).alias("cut"))
    rows = rows.select("doc_id", "cut.total", F.posexplode("cut.crcs").alias("piece", "ids_crc32"))
    start = F.col("piece").cast("long") * capacity
    return rows.select("doc_id", "piece", start.alias("start"), F.least(F.lit(capacity), F.col("total") - start).alias("length"), "ids_crc32")


class _Search:
    """Bins of one group under local search; items are known by their length."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.capacity = capacity
        self.bins: list[list[int]] = []  # item numbers
        self.fill: list[int] = []
        self.lengths = lengths.tolist()
        self._best_fit()

    def _best_fit(self) -> None:
        """Best-fit decreasing; `free` has a bit for every slack that some bin has."""
        with_slack: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        free = 0
        for i in sorted(range(len(self.lengths)), key=self.lengths.__getitem__, reverse=True):
            n = self.lengths[i]
            fits = free >> n
            if fits:
                slack = n + ((fits & -fits).bit_length() - 1)
                b = with_slack[slack].pop()
                if not with_slack[slack]:
                    free &= ~(1 << slack)
                self.bins[b].append(i)
                self.fill[b] += n
            else:
                b = len(self.bins)
                self.bins.append([i])
                self.fill.append(n)
            slack = self.capacity - self.fill[b]
            if slack:
                with_slack[slack].append(b)
                free |= 1 << slack

    def bound(self) -> int:
        """No packing needs fewer bins: the total, and the items over half that never meet."""
        return max(-(-sum(self.lengths) // self.capacity), sum(2 * n > self.capacity for n in self.lengths))

    # For every sum of one or two items of a bin: the most slack of an underfull bin that has it.
    def _open_index(self) -> None:
        self.version = [0] * len(self.bins)
        self.heaps: tuple[dict, dict, dict] = ({}, {}, {})
        self.most = np.zeros((3, self.capacity + 1), np.int64)
        for b in range(len(self.bins)):
            self._enter(b)

    def _enter(self, b: int) -> None:
        slack = self.capacity - self.fill[b]
        if not slack or not self.bins[b]:
            return
        ones = {self.lengths[i] for i in self.bins[b]}
        for kind, sums in ((0, {0}), (1, ones), (2, self._pair_sums(b))):
            heaps, most = self.heaps[kind], self.most[kind]
            for s in sums:
                heapq.heappush(heaps.setdefault(s, []), (-slack, b, self.version[b]))
                if slack > most[s]:
                    most[s] = slack

    def _pair_sums(self, b: int) -> set[int]:
        """Sums of two items of a bin."""
        by_length: dict[int, int] = {}
        for i in self.bins[b]:
            by_length[self.lengths[i]] = by_length.get(self.lengths[i], 0) + 1
        sizes = sorted(by_length)
        out = {2 * n for n in sizes if by_length[n] > 1}
        out.update(m + n for k, m in enumerate(sizes) for n in sizes[k + 1 :])
        return out

    def _holder(self, kind: int, total: int, need: int, donor: int) -> int | None:
        """A bin with `kind` items that sum up to `total` and at least `need` slack, no emptier
        than the donor.  Entries of bins that have changed, or are emptier, are dropped."""
        heap, own, hit = self.heaps[kind].get(total, []), None, None
        while heap:
            slack, b, version = heap[0]
            if b == donor and version == self.version[b]:
                own = heapq.heappop(heap)
            elif version != self.version[b] or self.fill[b] < self.fill[donor]:
                heapq.heappop(heap)
            else:
                hit = b if -slack >= need else None
                break
        if own:
            heapq.heappush(heap, own)
        self.most[kind][total] = -heap[0][0] if heap else 0
        return hit

    def _partner(self, kind: int, total: int, donor: int) -> tuple[int, int] | None:
        """(bin, sum): a bin that gives the smallest `sum` for `total` and can hold the difference."""
        if not kind:
            b = self._holder(0, 0, total, donor)
            return None if b is None else (b, 0)
        for s in np.nonzero(self.most[kind][:total] >= total - np.arange(total))[0].tolist():
            b = self._holder(kind, s, total - s, donor)
            if b is not None:
                return b, s
        return None

    def _take(self, b: int, kind: int, total: int) -> list[int]:
        """Items of bin `b`, `kind` of them, that sum up to `total`; they leave the bin."""
        if not kind:
            return []
        items = self.bins[b]
        if kind == 1:
            found = [next(i for i in items if self.lengths[i] == total)]
        else:
            at: dict[int, int] = {}
            found = []
            for i in items:
                if total - self.lengths[i] in at:
                    found = [i, at[total - self.lengths[i]]]
                    break
                at[self.lengths[i]] = i
        for i in found:
            items.remove(i)
        self.fill[b] -= total
        return found

    def _pairs(self, items: list[int]) -> list[tuple[list[int], int]]:
        """A pair of `items` (largest first) for every sum of two of them, largest sum first.

        The lengths of a bin that differ are few, as they add up to its fill at most."""
        by_length: dict[int, list[int]] = {}
        for i in items:
            by_length.setdefault(self.lengths[i], []).append(i)
        lengths = list(by_length)
        sums: dict[int, list[int]] = {}
        for n, x in enumerate(lengths):
            if len(by_length[x]) > 1:
                sums.setdefault(2 * x, by_length[x][:2])
            for y in lengths[n + 1 :]:
                sums.setdefault(x + y, [by_length[x][0], by_length[y][0]])
        return [(sums[total], total) for total in sorted(sums, reverse=True)]

    def _step(self, donor: int) -> bool:
        """One move or exchange that increases the squared fill, if there is one."""
        items = sorted(self.bins[donor], key=self.lengths.__getitem__, reverse=True)
        offers = [([i], self.lengths[i]) for i in items]
        # two of the donor's for one of the other's: a pair for every sum that two of them have
        offers += self._pairs(items)
        for given, total in offers:
            if total > self.capacity:
                continue
            for kind in (0, 1, 2) if len(given) == 1 else (1,):
                hit = self._partner(kind, total, donor)
                if not hit:
                    continue
                other, back = hit
                received = self._take(other, kind, back)
                for i in given:
                    self.bins[donor].remove(i)
                self.bins[donor] += received
                self.bins[other] += given
                self.fill[donor] += back - total
                self.fill[other] += total
                for b in (donor, other):
                    self.version[b] += 1
                    self._enter(b)
                return True
        return False

    def run(self) -> list[list[int]]:
        """Rounds over the underfull bins, emptiest first, until none has a step left.  Every
        step increases the sum of squared fills, so the rounds end."""
        bound = self.bound()
        count, moved = len(self.bins), True
        while moved and count > bound:
            moved = False
            self._open_index()
            for donor in sorted((b for b in range(len(self.bins)) if 0 < self.fill[b] < self.capacity), key=self.fill.__getitem__):
                while self.bins[donor] and self._step(donor):
                    moved = True
                if not self.bins[donor]:
                    count -= 1
                    if count <= bound:
                        break
        return [b for b in self.bins if b]


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Item numbers by bin; no bin's lengths add up to more than `capacity`."""
    return _Search(np.asarray(lengths, np.int64), capacity).run()


def pack_group(rows: pd.DataFrame, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every row by its `length`; full pieces are a bin each."""
    lengths = rows["length"].to_numpy(np.int64)
    where, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    full = np.nonzero(lengths == capacity)[0]
    where[full] = np.arange(len(full))
    rest = np.nonzero(lengths < capacity)[0]
    for k, items in enumerate(pack(lengths[rest], capacity)):
        at = rest[np.sort(np.array(items, np.int64))]
        where[at] = len(full) + k
        offset[at] = np.cumsum(lengths[at]) - lengths[at]
    return where, offset


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = stored(cut_pieces(docs, tokenizer_path or word_bpe_path(), capacity))
    groups = max(1, -(-pieces.count() // group))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # the same packing whatever order the rows arrive in
        rows = rows.sort_values(["length", "ids_crc32", "doc_id", "piece"], ascending=[False, True, True, True], kind="stable")
        where, offset = pack_group(rows, capacity)
        return rows.drop(columns="gid").assign(sequence_id=(rows["gid"].to_numpy(np.int64) << 32) + where, offset=offset)

    # The stored rows are the same in every run of a task, so a row's number deals it out evenly.
    dealt = pieces.withColumn("gid", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    dealt = dealt.withColumn("doc_id", F.col("doc_id").cast("string"))  # pandas has no whole numbers with nulls
    packed = dealt.groupBy("gid").applyInPandas(run, f"{PIECES}, sequence_id long, offset long")
    return packed.withColumn("doc_id", F.col("doc_id").cast("long"))


def op1_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
