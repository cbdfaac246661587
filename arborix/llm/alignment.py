"""Cross-tokenizer alignment by a dictionary of groups.

Two tokenizers encode each whole document. Where tokens of both end, the tokens since the last such place make a group: some ids of the
first and some of the second that cover the same bytes. Chunks of documents number their distinct groups, so a document keeps a short list of
numbers and times. Over the cluster each distinct group is interned once with its frequency, its links are expanded
once, and id pairs are counted from the frequencies. What a group adds to a document goes back by the group's key to the chunks that hold it,
and from there to their documents. A key is the group itself, never a hash.

A link is a pair of tokens, one of each tokenizer, whose byte ranges end together: the last ones of a group.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, hold, mix, n_parts, portions, trim

_CHUNKS = "chunk long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, found binary, distinct int, local int, key string, times long"
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Pair:
    """Both tokenizers and the bytes of their tokens. Text stands after one space for both."""

    def __init__(self, ranks_path: str, pattern: str, pieces_path: str):
        import sentencepiece
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks_path, "rb"))}
        self.a = tiktoken.Encoding("arborix-alignment", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, k in ranks.items():
            self.bytes_a[k] = token
        n = self.b.get_piece_size()
        names = [self.b.id_to_piece(k) for k in range(n)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(names)]
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both; None where either doesn't give back the text's bytes, or there is no text."""
        if not text:
            return None
        raw = (" " + text).encode("utf-8", "replace")
        a, b = self.a.encode_ordinary(" " + text), self.b.encode(text)
        if b"".join(map(self.bytes_a.__getitem__, a)) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return None
        return np.array(a, np.int32), np.array(b, np.int32)


@lru_cache(maxsize=1)
def _pair(ranks_path: str, pattern: str, pieces_path: str) -> Pair:
    """One for each Python worker."""
    return Pair(ranks_path, pattern, pieces_path)


def cut(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """First token of each group and how many it has, of the first tokenizer and of the second, and the byte where it ends."""
    end_a, end_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
    mark = np.zeros(int(end_a[-1]) + 1 if len(a) else 1, bool)
    mark[end_b] = True
    last_a = np.flatnonzero(mark[end_a])
    mark[end_b] = False
    mark[end_a] = True
    last_b = np.flatnonzero(mark[end_b])
    first_a, first_b = (np.concatenate(([0], x[:-1] + 1)) if len(x) else x for x in (last_a, last_b))
    return first_a, last_a - first_a + 1, first_b, last_b - first_b + 1, end_a[last_a]


def _flat(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of each group, in a row."""
    return np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))


def intern(a: np.ndarray, b: np.ndarray, first_a, n_a, first_b, n_b) -> tuple[np.ndarray, np.ndarray]:
    """A group of each kind and the kind of each group. Kinds are told apart by hashes, and every group is compared with its kind's first."""
    if not len(n_a):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    total = np.zeros(len(n_a), np.uint64)
    for ids, first, n, seed in ((a, first_a, n_a, 0x9E3779B97F4A7C15), (b, first_b, n_b, 0xC2B2AE3D27D4EB4F)):
        place = np.arange(len(ids)) - np.repeat(first, n)
        total = mix(total + np.add.reduceat(mix((place.astype(np.uint64) << np.uint64(32)) + ids.astype(np.uint64) + np.uint64(seed)), first))
    _, one, kind = np.unique(total, return_index=True, return_inverse=True)
    like = one[kind]
    same = np.array_equal(n_a, n_a[like]) and np.array_equal(n_b, n_b[like]) and np.array_equal(a, a[_flat(first_a[like], n_a)]) and np.array_equal(b, b[_flat(first_b[like], n_b)])
    if same:
        return one, kind
    known: dict[tuple, int] = {}
    groups = ((tuple(a[i : i + m].tolist()), tuple(b[j : j + n].tolist())) for i, m, j, n in zip(first_a, n_a, first_b, n_b, strict=True))
    kind = np.array([known.setdefault(g, len(known)) for g in groups])
    return np.unique(kind, return_index=True)[1], kind


def _chunked(paths: tuple[str, str, str], most: int):
    """Arrow function: a row for each document, and one for each distinct group of each chunk of about `most` characters."""

    def work(batches):
        from pyspark import TaskContext

        pair = _pair(*paths)
        hold("pair", _pair.cache_clear)
        names_a, names_b = ([str(k) for k in range(len(x))] for x in (pair.bytes_a, pair.bytes_b))
        part, nth = TaskContext.get().partitionId(), 0

        def flush(ids, codes):
            nonlocal nth
            chunk, nth = (part << 32) + nth, nth + 1
            empty = np.empty(0, np.int32)
            a, b = (np.concatenate([empty, *(c[k] for c in codes if c)]) for k in (0, 1))
            first_a, n_a, first_b, n_b, end = cut(a, b, pair.size_a, pair.size_b)
            one, kind = intern(a, b, first_a, n_a, first_b, n_b)
            keys = [",".join([names_a[x] for x in a[i : i + m].tolist()]) + "|" + ",".join([names_b[x] for x in b[j : j + n].tolist()]) for i, m, j, n in zip(first_a[one].tolist(), n_a[one].tolist(), first_b[one].tolist(), n_b[one].tolist(), strict=True)]
            rows, at, byte = [], 0, 0
            for doc, code in zip(ids, codes, strict=True):
                if code is None:
                    rows.append((doc, 0, 0, 0, "", b"", 0))
                    continue
                byte += int(pair.size_a[code[0]].sum())
                to = int(np.searchsorted(end, byte, "right"))
                own = kind[at:to]
                local, times = np.unique(own, return_counts=True)
                digest = hashlib.sha256(";".join([keys[k] for k in own.tolist()]).encode()).hexdigest()
                found = pa.compress(np.diff(local, prepend=0).astype("<u4").tobytes() + times.astype("<u4").tobytes(), "zstd", asbytes=True)
                rows.append((doc, len(code[0]), len(code[1]), to - at, digest, found, len(local)))
                at = to
            for k in range(0, len(rows), 1000):
                yield batch_of(chunk, rows[k : k + 1000], [])
            times = np.bincount(kind, minlength=len(keys))
            for k in range(0, len(keys), 20_000):
                yield batch_of(chunk, [], list(zip(range(k, k + 20_000), keys[k : k + 20_000], times[k : k + 20_000].tolist(), strict=False)))

        def batch_of(chunk, docs, groups):
            doc, group = (list(zip(*x, strict=True)) if x else [()] * k for x, k in ((docs, 7), (groups, 3)))
            n, types = len(docs) + len(groups), [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int32()]
            columns = [pa.array([chunk] * n, pa.int64())]
            columns += [pa.array(list(x) + [None] * len(groups), t) for x, t in zip(doc, types, strict=True)]
            columns += [pa.array([None] * len(docs) + list(x), t) for x, t in zip(group, (pa.int32(), pa.string(), pa.int64()), strict=True)]
            return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _CHUNKS.split(", ")])

        ids, codes, size = [], [], 0
        for batch in portions(batches, 256, keep="pair"):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py() or ""
                ids.append(doc)
                codes.append(pair.encode(text))
                size += len(text)
                if size >= most:
                    yield from flush(ids, codes)
                    ids, codes, size = [], [], 0
        if ids:
            yield from flush(ids, codes)
        trim()

    return work


def _returned(docs, groups):
    """The documents of a chunk with what their groups add; groups are rows (local, count, best)."""
    order = np.argsort(groups.column("local").to_numpy())
    count, best = (groups.column(c).to_numpy()[order].astype(np.int64) for c in ("count", "best"))
    sums = []
    for found, n in zip(docs.column("found"), docs.column("distinct").to_pylist(), strict=True):
        if not n:
            sums.append((0, 0, 0))
            continue
        local, times = np.frombuffer(pa.decompress(found.as_py(), 8 * n, "zstd"), "<u4").reshape(2, n).astype(np.int64)
        local = np.cumsum(local)
        sums.append((int(times.sum()), int((times * best[local]).sum()), int((times * count[local]).sum())))
    links = [pa.array([x[k] for x in sums], pa.int64()) for k in range(3)]
    own = [docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")]
    return pa.table([*own, *links, docs.column("groups_sha256")], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def dictionary(scratch: Scratch, entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, a, b, times): the distinct groups, each with its link; and (a, b, count, best): how many links hold an id pair, and whether no other has more with b."""
    last = lambda side: F.element_at(F.split(side, ","), -1).cast("int")
    link = (last(F.substring_index("key", "|", 1)).alias("a"), last(F.substring_index("key", "|", -1)).alias("b"))
    groups = scratch.save(entries.groupBy("key").agg(F.sum("times").alias("times")).select("key", *link, "times"))
    pairs = scratch.save(groups.groupBy("a", "b").agg(F.sum("times").alias("count")))
    most = pairs.groupBy("b").agg(F.max("count").alias("most"))
    return groups, pairs.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def align(docs: DataFrame, ranks_path: str, pattern: str, pieces_path: str, most: int = 8_000_000) -> DataFrame:
    """A row for each row (doc_id, text): tokens of both tokenizers, groups, links, links whose pair is their second id's most frequent (ties too),
    the links' summed counts, and the SHA-256 of the groups' ids.

    Null and empty texts, and texts that a tokenizer doesn't give back byte for byte, have zeros and an empty digest; a null doc_id stays null;
    repeated rows count each; very long texts are a chunk of their own; an empty table gives no row; further columns are ignored."""
    scratch = Scratch(docs.sparkSession, "alignment")
    made = scratch.save(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_chunked((ranks_path, pattern, pieces_path), most), _CHUNKS))
    entries = made.where("local IS NOT NULL").select("chunk", "local", "key", "times")
    entries = scratch.save_by(entries.repartition(n_parts(docs.sparkSession), "key"), "key")
    groups, pairs = dictionary(scratch, entries)
    values = groups.join(pairs, ["a", "b"]).select("key", "count", "best")
    back = entries.join(values, "key").select("chunk", "local", "count", "best")
    own = made.where("local IS NULL").drop("local", "key", "times")
    return own.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(_returned, _RESULT)
