"""Suffix-array dedup: repeated byte strings found by merging Burrows-Wheeler transforms.

Which 200-byte windows occur twice is settled in rounds of interleave refinement. A window's
anchor is the smallest hash among its 64-byte grams, so equal windows have equal anchors, and
neighbouring windows with one anchor form a chunk (of at most 1,024 windows, so a text of one letter
repeated is many equal chunks).

Round one runs over the cluster: the suffixes of all documents that start at anchors are counted
by their first 64 bytes; those that stand alone are final. Round two counts equal chunks: a chunk
that occurs twice is repeated as a whole, and one copy of it goes on. Round three works on
what is left of an anchor bucket: shards of chunks get their Burrows-Wheeler transforms, and the
transforms are merged by iterative interleave refinement: the interleave by k bytes is
refined to k + 7 bytes by seven steps through their LF maps, and only blocks (intervals of suffixes that
share k bytes) whose new bytes differ are put in order anew; all other suffixes keep the place that
their shard's sort gave them. A suffix alone in its block is dropped, and what stays after 200 bytes is
exactly the repeated windows: intervals of a common prefix of 200 bytes or more. An anchor with more chunks than a bucket holds is refined over the
cluster instead: the blocks of its windows by 200 bytes, named by their digests, are counted,
so that no group has to fit one task. Chunks and blocks are told apart by 96 and 128 bits of a BLAKE2 digest.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, mix, n_parts, portions, slices, trim

GRAM, HEAD, SLICE, LONG = 64, 7, 400_000, 1024
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of each GRAM bytes, by doublings."""
    h, width = _BYTE[raw], 1
    with np.errstate(over="ignore"):
        while width < GRAM:
            h = h[:-width] * np.uint64(pow(0xD6E8FEB86659FD93, width, 1 << 64)) + h[width:]
            width *= 2
        return mix(h)


def sliding_min(h: np.ndarray, window: int) -> np.ndarray:
    width = 1
    while width * 2 <= window:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    return np.minimum(h[: len(h) - (window - width)], h[window - width :])


def digests(raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit halves of the BLAKE2 digest of each raw[first:last], so that no two texts made to collide are taken as one."""
    held = memoryview(np.ascontiguousarray(raw))
    found = b"".join([hashlib.blake2b(held[a:b], digest_size=16).digest() for a, b in zip(first.tolist(), last.tolist(), strict=True)])
    halves = np.frombuffer(found, np.uint64).reshape(-1, 2)
    return np.ascontiguousarray(halves[:, 0]), np.ascontiguousarray(halves[:, 1])


def chunks(raw: np.ndarray, ends: np.ndarray, depth: int, digest: bool = True):
    """(text, start, windows, anchor, digests, many) of the chunks of texts joined in raw, with starts within the text.

    many tells that the anchor's gram stands more than once in the chunk, so that windows may repeat within it."""
    n = len(raw) - depth + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64), (np.empty(0, np.uint64),) * 2, np.empty(0, bool))
    width = depth - GRAM + 1
    grams = gram_hashes(raw)
    low = sliding_min(grams, width)
    valid = np.ones(n, bool)
    sizes = np.diff(np.concatenate(([0], ends)))
    for e, size in zip(ends.tolist(), sizes.tolist(), strict=True):  # windows that would cross a text's end
        valid[max(e - size, e - depth + 1) : e] = False
    start = valid & np.concatenate(([True], ~valid[:-1] | (low[1:] != low[:-1])))
    first = np.flatnonzero(start)
    stop = np.concatenate((first[1:], [n]))
    over = np.concatenate((np.cumsum(valid), [0]))
    count = over[stop - 1] - over[first] + 1
    if len(count) and count.max() > LONG:  # equal long runs are cut at equal places
        parts = -(-count // LONG)
        nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        first, count = np.repeat(first, parts) + nth * LONG, np.minimum(LONG, np.repeat(count, parts) - nth * LONG)
    doc = np.searchsorted(ends, first, "right")
    begin = np.concatenate(([0], ends))[doc]
    keys = (np.empty(0, np.uint64),) * 2
    if digest:
        keys = digests(raw, first, first + count + depth - 1)
    anchor = low[first]
    # a gram is an anchor where some window that holds it has no smaller one; those windows lie in one chunk
    most = ~sliding_min(~np.where(valid, low, 0), width) if n >= width else np.zeros(0, np.uint64)
    edge = np.arange(n + width - 1)
    edge = edge[(edge < width - 1) | (edge >= n)]
    place = np.concatenate((edge, width - 1 + np.flatnonzero(most == grams[width - 1 : n])))
    run = np.searchsorted(first, place, "right") - 1
    pending = np.flatnonzero(run >= 0)
    owner = np.full(len(place), -1)
    while len(pending):
        r, at = run[pending], place[pending]
        near = first[r] + count[r] + width - 2 >= at
        own = near & (anchor[r] == grams[at])
        owner[pending[own]] = r[own]
        pending = pending[near & ~own]
        run[pending] -= 1
        pending = pending[run[pending] >= 0]
    many = np.bincount(owner[owner >= 0], minlength=len(first)) > 1
    return doc, first - begin, count, anchor, keys, many


def _joined(batch: pa.RecordBatch, depth: int, most: int = SLICE):
    """Slices of a batch (text as binary): rows and offsets of their texts, the bytes, and the texts' ends.

    A text longer than a slice comes in parts, each of which has `depth` - 1 bytes of the next one."""
    texts = [x or b"" for x in batch.column("text").to_pylist()]
    for a, b in slices(batch, np.array([len(x) for x in texts], np.int64), most):
        own = texts[a:b]
        if b - a == 1 and len(own[0]) > most:
            for at in range(0, len(own[0]) - depth + 1, most):
                part = own[0][at : at + most + depth - 1]
                yield np.array([a]), np.array([at]), np.frombuffer(part, np.uint8), np.array([len(part)])
        else:
            yield np.arange(a, b), np.zeros(b - a, np.int64), np.frombuffer(b"".join(own), np.uint8), np.cumsum([len(x) for x in own])


def _anchors(depth: int):
    def work(batches):
        for batch in portions(batches):
            for _, _, raw, ends in _joined(batch, depth):
                *_, found, _, many = chunks(raw, ends, depth, digest=False)
                anchor, at, n = np.unique(found, return_inverse=True, return_counts=True)
                n = n + (np.bincount(at, many, len(n)) > 0)  # a gram that stands twice in a chunk counts twice
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(n.astype(np.int64))], ["anchor", "n"])

    return work


def _chunk_rows(depth: int):
    names = ["k", "th", "start", "windows", "anchor", "digest", "digest2", "many"]

    def work(batches):
        for batch in portions(batches):
            for row, offset, raw, ends in _joined(batch, depth):
                doc, start, count, anchor, keys, many = chunks(raw, ends, depth)
                if not len(doc):
                    continue
                own = pa.array(row[doc])
                yield pa.RecordBatch.from_arrays([batch.column("k").take(own), batch.column("th").take(own), pa.array((start + offset[doc]).astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(anchor.view(np.int64)), pa.array(keys[0].view(np.int64)), pa.array(keys[1].astype(np.uint32).view(np.int32)), pa.array(many)], names)

    return work


def _pack(batches):
    """Texts compressed, before they are shuffled; the other columns stay."""
    z = zstandard.ZstdCompressor(level=1)
    for batch in portions(batches):
        packed = pa.array([z.compress(x or b"") for x in batch.column("text").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([packed if c == "text" else batch.column(c) for c in batch.schema.names], ["z" if c == "text" else c for c in batch.schema.names])


def _cut(depth: int):
    """The bytes of wanted chunks."""

    def work(batches):
        z = zstandard.ZstdDecompressor()
        for batch in portions(batches, 64):
            rows: tuple[list, ...] = ([], [], [], [], [], [])
            for k, th, packed, wanted in zip(*(batch.column(c).to_pylist() for c in ("k", "th", "z", "wanted")), strict=True):
                text = z.decompress(packed)
                for w in wanted:
                    for to, x in zip(rows, (k, th, w["start"], w["anchor"], w["once"], text[w["start"] : w["start"] + w["windows"] + depth - 1]), strict=True):
                        to.append(x)
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(r, kind) for r, kind in zip(rows, kinds, strict=True)], ["k", "th", "start", "anchor", "once", "bytes"])

    return work


class Bwt:
    """The Burrows-Wheeler transform of several byte strings: suffixes in order (strings end in terminators, smaller than any byte and ordered by string), the symbol before each (0: none, else byte + 1) and the LF map.

    Suffixes are told apart by their first `depth` bytes at least; those that share more may stand in any order."""

    def __init__(self, strings: list[bytes], depth: int = 1 << 31):
        sizes = np.array([len(s) for s in strings], np.int64)
        self.text = text = np.zeros(int(sizes.sum()) + len(strings), np.uint16)
        self.begin = np.cumsum(sizes + 1) - sizes - 1
        inside = np.ones(len(text), bool)
        inside[self.begin + sizes] = False
        text[inside] = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint16) + 1
        n, width = len(text), HEAD
        self.room = room = (np.repeat(self.begin + sizes, sizes + 1) - np.arange(n)).astype(np.int32)  # symbols before the terminator
        self.left = (np.arange(n) - np.repeat(self.begin, sizes + 1)).astype(np.int32)
        head = np.zeros(n, np.uint64)
        for k in range(width):
            symbol = np.zeros(n, np.uint64)
            symbol[: n - k] = text[k:]
            symbol[room <= k] = 0
            head = (head << np.uint64(9)) | symbol
        self.head = head
        order = np.argsort(head)
        rank, ties = np.empty(n, np.int64), np.arange(n)
        self._rank(rank, order, ties, head[order])
        longest = min(depth, int(sizes.max(initial=0)) + 1)
        while width < longest:
            # only suffixes that still share their rank are sorted again
            ties = np.flatnonzero(self._shared(rank[order]))
            if not len(ties):
                break
            at = order[ties]
            key = rank[at] << 32
            more = room[at] >= width
            key[more] |= rank[at[more] + width] + 1
            by = np.argsort(key)
            order[ties] = at[by]
            self._rank(rank, order, ties, key[by])
            width *= 2
        self.order = order = order.astype(np.int32)
        self.symbols = np.where(order > 0, text[order - 1], 0).astype(np.uint16)
        place = np.empty(n, np.int32)
        place[order] = np.arange(n, dtype=np.int32)
        self.lf = place[order - 1]

    @staticmethod
    def _shared(rank: np.ndarray) -> np.ndarray:
        same = np.concatenate(([False], rank[1:] == rank[:-1], [False]))
        return same[:-1] | same[1:]

    @staticmethod
    def _rank(rank: np.ndarray, order: np.ndarray, places: np.ndarray, key: np.ndarray) -> None:
        """Give the suffixes at the places of the order, whose keys ascend, the first place of their key as rank."""
        if len(places):
            new = np.concatenate(([True], key[1:] != key[:-1]))
            rank[order[places]] = places[np.flatnonzero(new)][np.cumsum(new) - 1]


def merge(shards: list[Bwt], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix, block): the interleave of the shards' suffixes by `depth` bytes, without suffixes that share them with no other.

    Suffixes count through the shards in order; they are places in the shards' orders. Block numbers ascend.
    The interleave by HEAD bytes comes from the shards' heads; each round goes over HEAD bytes more to the left."""
    offsets = np.cumsum([0] + [len(s.order) for s in shards])
    lf = np.concatenate([s.lf + np.int32(o) for s, o in zip(shards, offsets[:-1], strict=True)])
    head = np.concatenate([s.head[s.order] for s in shards])
    first = []  # suffixes that can take all steps to the left, with HEAD bytes to their right
    for s, o in zip(shards, offsets[:-1], strict=True):
        first.append(np.flatnonzero(((s.room >= HEAD) & (s.left >= depth - HEAD))[s.order]) + o)
    at = np.concatenate(first).astype(np.int32)
    own = head[at]
    by = np.argsort(own)
    at, own = at[by], own[by]
    at, block = _drop(at, np.concatenate(([True], own[1:] != own[:-1], [True])) if len(at) else np.ones(1, bool))
    two = lf[lf]
    four = two[two]
    whole, left = four[two[lf]], depth - HEAD
    while left and len(at):
        step = min(HEAD, left)
        if step == HEAD:
            at = whole[at]
        else:
            for _ in range(step):
                at = lf[at]
        word = head[at] >> np.uint64(9 * (HEAD - step))  # the bytes that the steps went over
        split = (word[1:] != word[:-1]) & (block[1:] == block[:-1])
        if split.any():  # only blocks that split are put in order anew
            apart = np.zeros(int(block[-1]) + 1, bool)
            apart[block[1:][split]] = True
            places = np.flatnonzero(apart[block])
            by = places[np.lexsort((word[places], block[places]))]
            at[places], word[places] = at[by], word[by]
            at, block = _drop(at, np.concatenate(([True], (block[1:] != block[:-1]) | (word[1:] != word[:-1]), [True])))
        left -= step
    return at, block


def _drop(at: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number the blocks and drop those of one suffix; new marks where blocks start, and the end."""
    stay = ~(new[:-1] & new[1:])
    return at[stay], np.cumsum(new[:-1], dtype=np.int32)[stay]


def repeated(strings: list[bytes], depth: int, shard: int = 1 << 18) -> list[np.ndarray]:
    """Per string the starts of windows of `depth` bytes that start elsewhere in the strings too."""
    sizes = np.array([len(s) for s in strings], np.int64)
    parts = list(slices(None, sizes, shard))
    transforms = [Bwt(strings[a:b], depth) for a, b in parts]
    at, _ = merge(transforms, depth)
    owner, place = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    offsets = np.cumsum([0] + [len(t.order) for t in transforms])
    which = np.searchsorted(offsets, at, "right") - 1
    for k, t in enumerate(transforms):
        own = which == k
        suffix = t.order[at[own] - offsets[k]]
        string = np.searchsorted(t.begin, suffix, "right") - 1
        owner[own], place[own] = string + parts[k][0], suffix - t.begin[string]
    order = np.lexsort((place, owner))
    return np.split(place[order], np.searchsorted(owner[order], np.arange(1, len(strings))))


def _runs(starts: np.ndarray, depth: int) -> list[tuple[int, int]]:
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.concatenate(([0], cut + 1))].tolist(), (starts[np.concatenate((cut, [len(starts) - 1]))] + depth).tolist(), strict=True))


def _settle(depth: int):
    """Repeated spans of the chunks of one anchor bucket."""

    def work(table: pa.Table) -> pa.Table:
        k, th, start, once = (table.column(c).to_pylist() for c in ("k", "th", "start", "once"))
        found = repeated(table.column("bytes").to_pylist(), depth)
        trim()
        rows = [(k[i], th[i], start[i] + a, start[i] + b) for i, starts in enumerate(found) if once[i] for a, b in _runs(starts, depth)]
        return pa.table([pa.array([r[c] for r in rows], kind) for c, kind in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.int32()))], names=["k", "th", "lo", "hi"])

    return work


def _windows(depth: int):
    """The digest of every window of chunks, for anchors with more chunks than a bucket holds."""
    names = ["k", "th", "lo", "once", "w", "w2"]

    def work(batches):
        for batch in portions(batches):
            for k, th, start, once, raw in zip(*(batch.column(c).to_pylist() for c in ("k", "th", "start", "once", "bytes")), strict=True):
                raw = np.frombuffer(raw, np.uint8)
                n = len(raw) - depth + 1
                at = np.arange(n)
                found = [pa.array(x.view(np.int64)) for x in digests(raw, at, at + depth)]
                yield pa.RecordBatch.from_arrays([pa.array([k] * n, pa.int64()), pa.array([th] * n, pa.int32()), pa.array(np.arange(start, start + n, dtype=np.int32)), pa.array([once] * n), *found], names)

    return work


def _union(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s in sorted((s["lo"], s["hi"]) for s in spans or ()):
        if out and s[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s[1])
        else:
            out.append(list(s))
    return [tuple(x) for x in out]


def _remove(batches):
    z = zstandard.ZstdDecompressor()
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    for batch in portions(batches):
        rows = []
        for doc, packed, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "z", "spans")), strict=True):
            text, own = z.decompress(packed), _union(spans)
            edges = [0, *(x for s in own for x in s), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            rows.append((doc, len(text), len(text) - len(kept), len(own), hashlib.sha256(kept).hexdigest(), kept))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)


def _rewrite(names: list[str], text: str, n_chars: str | None):
    def work(batches):
        z = zstandard.ZstdDecompressor()
        for batch in portions(batches):
            columns = {c: batch.column(c) for c in names if c not in (text, n_chars)}
            texts = []
            for null, packed, spans in zip(*(batch.column(c).to_pylist() for c in ("null", "z", "spans")), strict=True):
                raw = z.decompress(packed)
                edges = [0, *(x for s in _union(spans) for x in s), len(raw)]
                texts.append(None if null else b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)).decode("utf-8", "ignore"))
            columns[text] = pa.array(texts, pa.string())
            if n_chars:
                columns[n_chars] = pa.array([None if t is None else len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names)

    return work


def _keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with text as bytes (null: empty) and a row's key: k is its doc_id (a hash of the text if null), th a hash of the text.

    Rows of one key have one text, so they have the same spans."""
    raw = F.coalesce(text, F.lit("")).cast("binary")
    return docs.withColumn("k", F.coalesce(F.col(doc_id).cast("long"), F.xxhash64(raw))).withColumn("th", F.hash(raw)).withColumn(text, raw)


def without_repeats(docs: DataFrame, depth: int = 200) -> DataFrame:
    """docs (doc_id, text, n_chars if there is one, and others) with texts cut to what dedup() leaves; a character that a cut splits goes too.

    Null texts stay null; rows that repeat a doc_id or have none stay, each with its own text; other columns may have any names."""
    spans = repeated_spans(docs, depth)
    place = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.toDF(*place.values())
    text, kinds = place["text"], {f"c{i}": f.dataType.simpleString() for i, f in enumerate(docs.schema)}
    n_chars = place.get("n_chars")
    kinds.update({n_chars: "bigint"} if n_chars else {})
    rest = [c for c in kinds if c not in (text, n_chars)]
    held = _keyed(rows.withColumn("null", F.col(text).isNull()), place["doc_id"], text).select(*rest, "null", "k", "th", F.col(text).alias("text"))
    held = held.mapInArrow(_pack, ", ".join([*(f"{c} {kinds[c]}" for c in rest), "null boolean, k long, th int, z binary"]))
    out = held.join(spans, ["k", "th"], "left").mapInArrow(_rewrite(list(kinds), text, n_chars), ", ".join(f"{c} {k}" for c, k in kinds.items()))
    return out.select([F.col(place[f.name]).cast(f.dataType).alias(f.name) for f in docs.schema])


def repeated_spans(docs: DataFrame, depth: int = 200, bucket_bytes: int = 1 << 20, hot: int = 1000) -> DataFrame:
    """(k, th, spans) of the rows of docs (doc_id, text) that have repeated bytes, spans as (lo, hi); k and th as in _keyed().

    Anchors with more than `hot` different chunks are refined over the cluster, all others in buckets of about `bucket_bytes`."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix")
    rows = _keyed(docs.select("doc_id", "text")).select("k", "th", "text")
    long = rows.where(F.octet_length("text") >= depth)
    anchors = long.select("text").mapInArrow(_anchors(depth), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
    every = long.mapInArrow(_chunk_rows(depth), "k long, th int, start int, windows int, anchor long, digest long, digest2 int, many boolean")
    again = scratch.save(every.join(anchors, "anchor", "left_semi"))
    kind = ["anchor", "digest", "digest2"]
    classes = scratch.save(again.groupBy(*kind).agg(F.count("*").alias("n"), F.min(F.struct("k", "th", "start", "windows")).alias("rep"), F.max("many").alias("many")))
    whole = again.join(classes.where("n > 1").select(*kind), kind, "left_semi").select("k", "th", F.col("start").alias("lo"), (F.col("start") + F.col("windows") + (depth - 1)).cast("int").alias("hi"))
    several = classes.groupBy("anchor").agg(F.count("*").alias("kinds"), F.max(F.col("many") & (F.col("n") == 1)).alias("inner")).where("kinds > 1 OR inner").select("anchor", "kinds")
    wanted = classes.join(several, "anchor").select("anchor", "kinds", (F.col("n") == 1).alias("once"), "rep.*")
    per_doc = wanted.groupBy("k", "th").agg(F.collect_list(F.struct("start", "windows", "anchor", "once")).alias("wanted"))  # chunks of one document
    packed = long.mapInArrow(_pack, "k long, th int, z binary")
    cut = packed.join(per_doc, ["k", "th"]).mapInArrow(_cut(depth), "k long, th int, start int, anchor long, once boolean, bytes binary")
    cut = scratch.save(cut.join(several.where(F.col("kinds") > hot).select("anchor", F.lit(True).alias("hot")), "anchor", "left"))
    total = cut.where("hot is null").agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    buckets = max(n_parts(spark), -(-int(total) // bucket_bytes))
    settled = cut.where("hot is null").groupBy(F.pmod(F.xxhash64("anchor"), F.lit(buckets)).alias("bucket")).applyInArrow(_settle(depth), "k long, th int, lo int, hi int")
    spread = cut.where("hot").select("k", "th", "start", "once", "bytes").mapInArrow(_windows(depth), "k long, th int, lo int, once boolean, w long, w2 long")
    twice = spread.groupBy("w", "w2").agg(F.count("*").alias("n")).where("n > 1").select("w", "w2")
    counted = spread.where("once").join(twice, ["w", "w2"], "left_semi").select("k", "th", "lo", (F.col("lo") + depth).cast("int").alias("hi"))
    spans = whole.unionByName(settled).unionByName(counted)
    return spans.groupBy("k", "th").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))  # spans of one document


def dedup(docs: DataFrame, depth: int = 200, bucket_bytes: int = 1 << 20, hot: int = 1000) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row (doc_id, text); kept is the bytes left.

    Every byte that a repeated string of `depth` bytes covers goes, all copies alike. Null texts are empty;
    repeated rows are copies of each other; rows without a doc_id are treated like others; an empty table gives
    no row; further columns are ignored."""
    spans = repeated_spans(docs, depth, bucket_bytes, hot)
    packed = _keyed(docs.select("doc_id", "text")).select("doc_id", "k", "th", "text").mapInArrow(_pack, "doc_id long, k long, th int, z binary")
    return packed.join(spans, ["k", "th"], "left").mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
