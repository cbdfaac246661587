"""Best-fit packing of token sequences, in bulk-synchronous rounds over a table of gaps.

Documents are tokenised once; longer ones are cut into full pieces. As many empty gaps as the
tokens need at least are opened. In each round pieces and gaps are range-sorted together by size, a
piece before the gaps that it fills, and swept: a task gives its pieces, longest first, to the smallest
of its gaps that hold them. What a range has no gap for goes to the next ranges' gaps that nothing
has touched: tasks only report how many of both they have left, the counts are matched from the
shortest range up, and pieces and gaps meet by their rank among what their range left, so no gap
gets two pieces. Gaps are then updated, and the next round follows. Once nothing fits, more gaps
are opened. Few rows are one range, swept like any other. The driver holds a row for each range, never pieces or gaps.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from collections import deque
from collections.abc import Sequence
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, hold, portions, slices, texts_of

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


#: Words of one run of letters that have no other composed form, and then perhaps one run of marks: one or two pieces to the tokenizer.
_PLAIN = re.compile(r"[a-zÀ-ÖØ-öø-ÿ]+([.,;:!?*#$%&|]*)")


class WordIds:
    """Ids of white-space delimited words, remembered up to about `most` distinct words; when full, those seen in several texts stay.

    The tokenizer drops white space and never merges across it, so a text's ids are its words' ids in a row.
    New words are encoded together: plain ones, without their marks, in long rows, which are cut again where a piece's last token
    tells its end; what they are made of is remembered with them."""

    def __init__(self, path: str, most: int = 500_000, longest: int = 64):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.longest = Tokenizer.from_file(path), most, longest
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(names.values()) + 1, bool)
        self.ends[[k for name, k in names.items() if name.endswith("</w>")]] = True
        self.rows = bool(self.ends.any())
        self.reset()

    def reset(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.used = np.empty(1 << 16, np.uint32), 0
        self.start, self.size, self.hits = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32), np.zeros(1 << 14, np.int32)

    def _forget(self, room: int) -> None:
        """Keep at most `room` words, those of the most texts, and none of a single text."""
        n = len(self.known)
        kept = np.flatnonzero(self.hits[:n] > 1)
        if len(kept) > room:
            kept = np.sort(kept[np.argsort(-self.hits[kept], kind="stable")[:room]])
        words, start, size, hits, flat = list(self.known), self.start[kept], self.size[kept], self.hits[kept], self.flat
        self.reset()
        if len(kept):
            at = np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
            self._put([words[k] for k in kept.tolist()], flat[at], size)
            self.hits[: len(kept)] = hits // 2  # what was common long ago may go later

    def _put(self, words: list[bytes], ids: np.ndarray, size: np.ndarray) -> None:
        k, n = len(self.known), len(words)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.empty_like(self.flat)))
        while k + n > len(self.start):
            self.start, self.size, self.hits = (np.concatenate((x, np.zeros_like(x))) for x in (self.start, self.size, self.hits))
        self.flat[self.used : self.used + len(ids)] = ids
        self.size[k : k + n] = size
        self.start[k : k + n] = self.used + np.cumsum(size) - size
        self.used += len(ids)
        self.known.update(zip(words, range(k, k + n), strict=True))

    def learn(self, words: set[bytes]) -> None:
        if len(self.known) + len(words) > self.most:
            self._forget(max(0, min(self.most // 2, self.most - len(words))))
        plain, marked, rest = {}, [], []  # a word with marks has the ids of its letters and then of the marks
        for w in words:
            if w in self.known:
                continue
            m = _PLAIN.fullmatch(text := w.decode("utf-8", "replace")) if self.rows else None
            if not m:
                rest.append((w, text))
            elif n := len(m[1]):
                stem, marks = w[:-n], w[-n:]
                marked.append((w, stem, marks))
                if stem not in self.known:
                    plain[stem] = text[:-n]
                if marks not in self.known:
                    plain[marks] = m[1]
            else:
                plain[w] = text
        rows = list(plain.items())
        for a in range(0, len(rows), 250):
            own = rows[a : a + 250]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(t for _, t in own)], add_special_tokens=False)[0].ids, np.uint32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(own):
                self._put([w for w, _ in own], ids, np.diff(stops, prepend=0))
            else:
                rest += own
        if rest:
            found = [e.ids for e in self.tokenizer.encode_batch_fast([t for _, t in rest], add_special_tokens=False)]
            self._put([w for w, _ in rest], np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64))
        if marked:
            names, stems, marks = zip(*marked, strict=True)
            at = np.column_stack((self._look(stems), self._look(marks)))
            size = self.size[at]
            self._put(list(names), self._ids(at.ravel()), size.sum(1))

    def _ids(self, at: np.ndarray) -> np.ndarray:
        """The ids of the words at these places, in a row."""
        size = self.size[at]
        return self.flat[np.repeat(self.start[at] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))]

    def _look(self, words: Sequence[bytes]) -> np.ndarray:
        """The places of words, -1 for what isn't known."""
        return np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        raw = [t.encode("utf-8", "replace") for t in texts]
        split = [r.lower().split() for r in raw]  # the tokenizer lowers letters itself; only special tokens' names could change
        long = [b"<|" in r for r in raw]
        places = [self._look([] if odd else words) for words, odd in zip(split, long, strict=True)]
        new = {words[k] for words, at in zip(split, places, strict=True) for k in np.flatnonzero(at < 0).tolist()}
        if over := {w for w in new if len(w) > self.longest}:  # texts with a very long word are encoded whole
            long = [odd or not over.isdisjoint(words) for odd, words in zip(long, split, strict=True)]
            new -= over
        if full := len(self.known) + len(new) > self.most:
            new = set().union(*(words for words, odd in zip(split, long, strict=True) if not odd))
            if len(new) > self.most and len(texts) > 1:
                return [ids for t in texts for ids in self.encode([t])]
        self.learn(new)
        out = []
        for text, words, at, odd in zip(texts, split, places, long, strict=True):
            if odd:
                out.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32))
                continue
            if full:  # what was known has other places now
                at = self._look(words)
            else:
                miss = np.flatnonzero(at < 0)
                at[miss] = self._look([words[k] for k in miss.tolist()])
            self.hits[at] += 1  # a text counts once
            out.append(self._ids(at))
        return out


@lru_cache(maxsize=1)
def _words(path: str) -> WordIds:
    """One for each Python worker, so that later tasks know the words of earlier ones."""
    return WordIds(path)


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """One row per piece of at most `capacity` tokens."""

    def cut(batches):
        words = _words(tokenizer)
        hold("words", _words.cache_clear)
        for batch in portions(batches, 1024, keep="words"):
            rows: tuple[list, ...] = ([], [], [], [], [])
            texts = texts_of(batch)
            found = (ids for a, b in slices(batch, np.array([len(t) for t in texts]), 500_000) for ids in words.encode(texts[a:b]))
            for doc, ids in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    for to, x in zip(rows, (doc, k, at, len(part), zlib.crc32(part.tobytes())), strict=True):
                        to.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def fill(counts: dict[int, int], gaps: dict[int, int]) -> list[tuple[int, int, int, int]]:
    """Best fit of classes of lengths into classes of gaps, longest first: (first rank, pieces, first gap, its size then) of each match.

    Ranks count pieces from the longest class down, gaps count from the smallest class up. Equal gaps are filled in the order
    they came up; pieces that no gap holds keep their ranks and are in no match."""
    sizes, held, at = sorted(gaps), {}, 0
    for size in sizes:
        held[size] = deque([(at, gaps[size])])
        at += gaps[size]
    matches, rank = [], 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left and (k := bisect.bisect_left(sizes, length)) < len(sizes):
            gap = sizes[k]
            first, have = held[gap].popleft()
            times = min(gap // length, left)  # what a piece leaves of the smallest gap is smaller still, and takes the next one
            n = min(have, left // times)
            if n < have:
                held[gap].appendleft((first + n, have - n))
            elif not held[gap]:
                del held[gap]
                sizes.pop(k)
            if rest := gap - times * length:
                if rest not in held:
                    held[rest] = deque()
                    bisect.insort(sizes, rest)
                held[rest].append((first, n))
            matches += [(rank + i * n, n, first, gap - i * length) for i in range(times)]
            rank, left = rank + times * n, left - times * n
        rank += left
    return matches


_STATE = "gap boolean, id long, size long"


def _assign(lengths: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Best fit of lengths, longest first, into rooms, smallest first: rows (piece, gap, its size then), as `fill` matches them."""
    counted = (dict(zip(*(x.tolist() for x in np.unique(v, return_counts=True)), strict=True)) for v in (lengths, room))
    found = np.array(fill(*counted), np.int64).reshape(-1, 4)
    n = found[:, 1]
    step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return np.column_stack((np.repeat(found[:, 0], n) + step, np.repeat(found[:, 2], n) + step, np.repeat(found[:, 3], n)))


def _sweep(capacity: int):
    """One range of a round: (gap, id, size, sequence_id, offset, part, nth), -1 for what there isn't.

    A piece has the sequence and offset that it got, or else its rank among the range's pieces left, from the longest; a gap has
    its new size and, if nothing touched it, its rank among those, from the smallest."""

    def sweep(batches):
        from pyspark import TaskContext

        part, table = TaskContext.get().partitionId(), pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if table is None:
            return
        gap, ids, size = (table.column(x).to_numpy() for x in ("gap", "id", "size"))
        docs, gaps = np.flatnonzero(~gap)[::-1], np.flatnonzero(gap)  # the range is sorted by size
        lengths, room = size[docs], size[gaps]
        doc, to, then = _assign(lengths, room).T
        sequence, offset, nth = (np.full(len(ids), -1) for _ in range(3))
        sequence[docs[doc]], offset[docs[doc]] = ids[gaps[to]], capacity - then
        taken = np.zeros(len(gaps), np.int64)
        np.add.at(taken, to, lengths[doc])
        left, free = docs[sequence[docs] < 0], gaps[taken == 0]
        nth[left], nth[free] = np.arange(len(left)), np.arange(len(free))
        size = size.copy()
        size[gaps] -= taken
        out = pa.table([gap, ids, size, sequence, offset, np.full(len(ids), part), nth], ["gap", "id", "size", "sequence_id", "offset", "part", "nth"])
        yield from out.to_batches(max_chunksize=10_000)

    return sweep


def _meet(ranges: list[tuple[int, int, int, int, int]]) -> tuple[list[tuple[bool, int, int, int, int, int]], int]:
    """What meets, from ranges (part, pieces left, gaps untouched, longest such piece, least such gap), shortest first.

    Runs (gap, part, first nth, last nth, first link, rows for each link), and how many pieces they have. A range's untouched
    gaps hold its shorter ranges' pieces left, so they take the nearest such range's, the longest first, and each gap as many
    at once as the least of the gaps holds of the longest of the pieces, which is what best fit does with equal ones."""
    waiting, runs, link, met = [], [], 0, 0
    for part, left, free, longest, least in ranges:
        at = 0
        while at < free and waiting:
            own, first, have, size = waiting.pop()
            times = least // size
            gaps = min(free - at, -(-have // times))
            n = min(have, gaps * times)
            runs += [(False, own, first, first + n - 1, link, times), (True, part, at, at + gaps - 1, link, 1)]
            at, link, met = at + gaps, link + gaps, met + n
            if n < have:
                waiting.append((own, first + n, have - n, size))
        if left:
            waiting.append((part, 0, left, longest))
    return runs, met


def best_fit(scratch: Scratch, pieces: DataFrame, capacity: int, most: int = 500_000) -> DataFrame:
    """(id, sequence_id, offset) for each piece (id, length) of a saved table, none longer than the capacity; ids are distinct.

    Ranges hold about `most` pieces and gaps, which bounds what a task holds; there are as many of them as the rows need,
    so a small table, and what is left in late rounds, is one range of the same sweep."""
    spark = scratch.spark
    state = pieces.select(F.lit(False).alias("gap"), "id", F.col("length").alias("size"))
    missing, left = pieces.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
    opened, gaps, placed, stuck = 0, 0, [], True
    while left:
        if stuck:
            more = -(-missing // capacity)
            state = state.unionByName(spark.range(opened, opened + more).select(F.lit(True).alias("gap"), "id", F.lit(capacity).cast("long").alias("size")))
            opened, gaps = opened + more, gaps + more
        order = ["size", "gap", "id"]
        count = -(-(left + gaps) // most)
        dealt = state.repartitionByRange(count, *order) if count > 1 else state.repartition(1)
        swept = scratch.save(dealt.sortWithinPartitions(*order).mapInArrow(_sweep(capacity), _STATE + ", sequence_id long, offset long, part long, nth long"))
        waits, free = (F.col("nth") >= 0) & ~F.col("gap"), (F.col("nth") >= 0) & F.col("gap")
        size = lambda which: F.when(which, F.col("size"))
        sums = [F.count_if(waits).alias("left"), F.count_if(free).alias("free"), F.max(size(waits)).alias("longest"), F.min(size(free)).alias("least"), F.count_if(F.col("gap") & (F.col("size") > 0)).alias("gaps"), F.count_if(F.col("sequence_id") >= 0).alias("put"), F.coalesce(F.sum(size(waits)), F.lit(0)).alias("tokens")]
        ranges = sorted(swept.groupBy("part").agg(*sums).collect())  # a row for each range
        runs, met = _meet([(r["part"], r["left"], r["free"], r["longest"], r["least"]) for r in ranges])
        left, gaps, missing = sum(r["left"] for r in ranges) - met, sum(r["gaps"] for r in ranges), sum(r["tokens"] for r in ranges)
        stuck = not runs and (count == 1 or not any(r["put"] for r in ranges))  # what one range leaves fits none of its gaps
        placed.append(swept.where("sequence_id >= 0").select("id", "sequence_id", "offset"))
        rest = swept.where("sequence_id < 0 AND size > 0")
        state = rest.select("gap", "id", "size")
        if runs:
            links = spark.createDataFrame(runs, "gap boolean, part long, a long, b long, link long, times long")  # at most four rows for each range
            linked = rest.join(F.broadcast(links), (rest.gap == links.gap) & (rest.part == links.part) & rest.nth.between(links.a, links.b), "left")
            linked = linked.select(rest.gap, "id", "size", (links.link + F.expr("(nth - a) DIV times")).alias("link"))
            rooms = linked.where("gap").select("link", F.col("id").alias("sequence_id"), F.col("size").alias("room"))
            own = Window.partitionBy("link").orderBy(F.desc("size"), "id").rowsBetween(Window.unboundedPreceding, 0)  # at most `times` rows
            found = scratch.save(linked.where("NOT gap").join(rooms, "link").withColumn("filled", F.sum("size").over(own)).withColumn("end", F.lead("id").over(Window.partitionBy("link").orderBy(F.desc("size"), "id")).isNull()))
            placed.append(found.select("id", "sequence_id", (capacity - F.col("room") + F.col("filled") - F.col("size")).alias("offset")))
            state = linked.where("link IS NULL").select("gap", "id", "size").unionByName(found.where("end AND room > filled").select(F.lit(True).alias("gap"), F.col("sequence_id").alias("id"), (F.col("room") - F.col("filled")).alias("size")))
    out = placed[0] if placed else pieces.select("id", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    for x in placed[1:]:
        out = out.unionByName(x)
    return out


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Pack all documents (doc_id, text) into sequences of at most `capacity` tokens.

    Null and empty texts hold `end_id` alone; repeated rows are packed once each; pieces of equal length go in any order;
    an empty table gives no row; further columns are ignored."""
    scratch = Scratch(docs.sparkSession, "packing")
    cut = scratch.save(pieces(docs, tokenizer, capacity, end_id).withColumn("id", F.monotonically_increasing_id()))
    return cut.join(best_fit(scratch, cut, capacity), "id").drop("id")
