"""Language identification with hyperdimensional profiles.

Every code point that is a letter has a random vector of +1 and -1 of its own. The vector of a trigram binds (multiplies) its
letters' vectors, each permuted (rotated) by its place; a document's vector bundles (adds) the
vectors of its trigrams; a language's prototype bundles the unit vectors of its training
documents. A document goes to the prototype of largest cosine.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import hash_bucket, mix, portions, texts_of

DIMS = 1024


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    out = np.zeros(0x110000, bool)
    out[[c for c in range(0x33480) if chr(c).isalpha()]] = True
    return out


def letter_vectors(points: np.ndarray) -> np.ndarray:
    """The random vector of each code point: hashed bits as +1 and -1, so every letter of every script has its own."""
    words = np.arange(1, DIMS // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        bits = mix(mix(points.astype(np.uint64) + np.uint64(11))[:, None] + words[None])
    return np.unpackbits(bits.view(np.uint8).reshape(len(points), DIMS // 8), axis=1).astype(np.int8) * 2 - 1


class Letters:
    """The vectors of the letters met so far, rotated by their three places; 0 stands for what is no letter. Starts anew when full."""

    def __init__(self, most: int = 1 << 13):
        self.most = most
        self.reset()

    def reset(self) -> None:
        self.number = np.zeros(0x110000, np.int32)
        base = letter_vectors(np.zeros(1, np.uint32))
        self.places = [np.roll(base, 2, axis=1), np.roll(base, 1, axis=1), base]

    def numbers(self, points: np.ndarray) -> np.ndarray:
        """Numbers of the code points; 0 for what is no letter."""
        s = self.number[points]
        new = np.unique(points[(s == 0) & _is_letter()[points]])
        if len(new):
            if len(new) + len(self.places[0]) > self.most and len(self.places[0]) > 1:
                self.reset()
                return self.numbers(points)
            have, base = len(self.places[0]), letter_vectors(new)
            self.number[new] = np.arange(have, have + len(new))
            self.places = [np.concatenate((p, np.roll(base, k, axis=1))) for p, k in zip(self.places, (2, 1, 0), strict=True)]
            s = self.number[points]
        return s


@lru_cache(maxsize=1)
def _letters() -> Letters:
    return Letters()


def _trigrams(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Distinct trigrams of letter numbers and their times; None without a letter."""
    s = _letters().numbers(np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32))
    if not s.any():
        return None
    s = np.concatenate(([0], s, [0])).astype(np.int64)
    s = s[np.concatenate(([True], (s[1:] != 0) | (s[:-1] != 0)))]
    if len(s) < 3:
        s = np.concatenate((s, np.zeros(3 - len(s), np.int64)))
    width = int(s.max()) + 1
    key = (s[:-2] * width + s[1:-1]) * width + s[2:]
    kinds, counts = np.unique(key.astype(np.int32) if width <= 1290 else key, return_counts=True)
    kinds = kinds.astype(np.int64)
    return np.stack((kinds // (width * width), kinds // width % width, kinds % width)), counts


def vector(text: str, found=None) -> np.ndarray | None:
    """The bundled trigram vector of a whole text as a unit vector; None without a letter."""
    found = found or _trigrams(text)
    if found is None:
        return None
    kinds, counts = found
    a, b, c = _letters().places
    out = np.zeros(DIMS, np.float32)
    for i in range(0, len(counts), 2048):
        x, y, z = kinds[:, i : i + 2048]
        bound = a[x] * b[y] * c[z]
        out += counts[i : i + 2048].astype(np.float32) @ bound.astype(np.float32)
    norm = float(np.sqrt((out.astype(np.float64) ** 2).sum()))
    return out / norm if norm else None


def size_class(text: str) -> int:
    """The bits of the number of trigrams that a text has in effect: one word repeated is as short as the word."""
    found = _trigrams(text)
    return 0 if found is None else _size(found)


def _size(found: tuple[np.ndarray, np.ndarray]) -> int:
    return int(found[1].sum() ** 2 // (found[1].astype(np.int64) ** 2).sum()).bit_length()


def _learned(docs: DataFrame) -> DataFrame:
    """The rows that teach: those with a lang and a text."""
    return docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())


def fit(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Prototypes from all rows (text, lang) with a lang and a text.

    A task sums its unit vectors by language, so what is shuffled is a vector for each task and language."""

    def bundle(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in portions(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch), strict=True):
                if (v := vector(text)) is not None:
                    sums[lang] = sums.get(lang, 0) + v.astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([x.tolist() for x in sums.values()], pa.list_(pa.float64()))], ["lang", "v"])

    parts = _learned(docs).select("lang", "text").mapInArrow(bundle, "lang string, v array<double>")
    dims = parts.select("lang", F.posexplode("v").alias("k", "x")).groupBy("lang", "k").agg(F.sum("x").alias("x"))
    got = dims.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("k", "x"))).alias("v")).orderBy("lang").collect()
    names = [r["lang"] for r in got]
    protos = np.array([[x["x"] for x in r["v"]] for r in got]).reshape(len(got), DIMS)
    return names, protos / np.maximum(np.linalg.norm(protos, axis=1, keepdims=True), 1e-12)


def predict(docs: DataFrame, names: list[str], protos: np.ndarray, held_out=None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row (doc_id, text).

    A null text or one without a letter gives `und` and 0; equal cosines go to the first name in order;
    repeated rows are scored each; without prototypes all are `und`."""
    held_out = F.lit(None).cast("boolean") if held_out is None else held_out

    def score(batches):
        for batch in portions(batches):
            found = [vector(t) if len(names) else None for t in texts_of(batch)]
            best = [None if v is None else protos @ v.astype(np.float64) for v in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(["und" if b is None else names[int(b.argmax())] for b in best], pa.string()), pa.array([0.0 if b is None else float(min(1, max(0, b.max()))) for b in best], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(score, "doc_id long, held_out boolean, lang_pred string, score double")


def floors(docs: DataFrame, names: list[str], protos: np.ndarray, least: float, low: float = 0.001, slack: float = 0.8, enough: int = 10) -> list[float]:
    """The least cosine that a text of each size class needs: slack times the low quantile of all learned texts of that class.

    Texts are counted by cosines cut to four places, so no class is gathered in one task; the quantile is the cut cosine of the text of
    that rank. A class of fewer than `enough` learned texts takes the next shorter one's, the shortest take `least`."""
    found: dict[int, tuple[int, float]] = {}
    if len(names):

        def score(batches):
            for batch in portions(batches):
                texts = [(t, g, v) for t in texts_of(batch) if (g := _trigrams(t)) is not None and (v := vector(t, g)) is not None]
                yield pa.RecordBatch.from_arrays([pa.array([_size(g) for _, g, _ in texts], pa.int32()), pa.array([float((protos @ v.astype(np.float64)).max()) for _, _, v in texts], pa.float64())], ["size", "cosine"])

        cells = _learned(docs).select("text").mapInArrow(score, "size int, cosine double").groupBy("size", F.floor(F.col("cosine") * 10000).alias("cell")).agg(F.count("*").alias("c"))
        of_class = Window.partitionBy("size")
        ranked = cells.withColumn("n", F.sum("c").over(of_class)).withColumn("upto", F.sum("c").over(of_class.orderBy("cell")))  # at most 20,001 cells a class
        rows = ranked.where(F.col("upto") > (F.col("n") - 1) * low).groupBy("size").agg(F.first("n").alias("n"), (F.min("cell") / 10000).alias("q"))
        found = {r["size"]: (r["n"], r["q"]) for r in rows.collect()}  # a row for each size class
    out = [least]
    for k in range(1, 33):
        n, q = found.get(k, (0, 0.0))
        out.append(max(least, slack * q) if n >= enough else out[-1])
    return out


def keep(docs: DataFrame, names: list[str], protos: np.ndarray, least: list[float]) -> DataFrame:
    """Those rows of docs (with a column text) that have a language with a cosine of their size class's `least` or more; all their columns."""

    def work(batches):
        for batch in portions(batches):
            texts = texts_of(batch)
            stay = []
            for t in texts:
                grams = _trigrams(t) if len(names) else None
                v = vector(t, grams) if grams else None
                stay.append(v is not None and float((protos @ v.astype(np.float64)).max()) >= least[_size(grams)])
            yield batch.filter(pa.array(stay, pa.bool_()))

    return docs.mapInArrow(work, docs.schema)


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows whose crc32(doc_id) mod 3 is not 1, predict all."""
    held = hash_bucket("doc_id", 3) == 1
    names, protos = fit(docs.where(~held))
    return predict(docs, names, protos, held)
