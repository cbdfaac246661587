"""Quality classifier: histogram gradient-boosted trees over document statistics.

Values are put into quantile bins once; a tree grows level by level from histograms of
gradients; trees are kept as full binary trees in three arrays (feature, threshold, leaf value), so
a batch of documents goes down all trees at once with array indexing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_bucket, portions, texts_of

FEATURES = (
    "bytes", "words", "word_bytes", "word_bytes_sd", "distinct_words", "top_word", "top5_words", "lines", "line_words", "distinct_lines", "repeated_bytes",
    "short_lines", "lower", "upper", "digit", "space", "high", "stop", "comma", "bang", "symbol", "pipe", "quote", "slash", "runs", "upper_words", "odd_ends", "entropy", "distinct_bytes", "digit_words",
)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*+<=>@[\\]^_`{|}~"]] = True


def statistics(text: str) -> list[float]:
    """The statistics of a whole text, in the order of FEATURES."""
    raw = text.encode("utf-8", "replace")
    n = len(raw)
    a = np.frombuffer(raw, np.uint8)
    count = np.bincount(a, minlength=256)
    words = text.split()
    m = len(words)
    size = np.fromiter(map(len, words), np.int64, m)
    kinds: dict[str, int] = {}
    for w in words:
        kinds[w] = kinds.get(w, 0) + 1
    top = sorted(kinds.values(), reverse=True)[:5]
    lines = [x for x in text.split("\n") if x]
    own = set(lines)
    p = count[count > 0] / max(1, n)
    d, w, k = max(1, n), max(1, m), max(1, len(lines))
    return [
        np.log1p(n), np.log1p(m), float(size.mean()) if m else 0.0, float(size.std()) if m else 0.0, len(kinds) / w, top[0] / w if top else 0.0, sum(top) / w, np.log1p(len(lines)), m / k, len(own) / k,
        1 - sum(map(len, own)) / max(1, sum(map(len, lines))), sum(len(x) < 30 for x in lines) / k, count[97:123].sum() / d, count[65:91].sum() / d, count[48:58].sum() / d, (count[32] + count[10] + count[9]) / d, count[128:].sum() / d,
        count[46] / d, count[44] / d, (count[33] + count[63]) / d, count[_SYMBOL].sum() / d, count[124] / d, (count[34] + count[39]) / d, (count[47] + count[58]) / d, float((a[1:] == a[:-1]).mean()) if n > 1 else 0.0,
        sum(x.isupper() for x in words) / w, sum(not x[-1].isalpha() for x in words) / w, float(-(p * np.log2(p)).sum()), np.log1p((count > 0).sum()), sum(x[0].isdigit() for x in words) / w,
    ]


class Trees:
    """Flat arrays of full binary trees of one depth."""

    def __init__(self, depth: int, base: float):
        self.depth, self.base = depth, base
        self.feature = np.zeros((0, 2**depth - 1), np.int32)
        self.threshold = np.zeros((0, 2**depth - 1))
        self.leaf = np.zeros((0, 2**depth))

    def margin(self, x: np.ndarray) -> np.ndarray:
        row, tree = np.arange(len(x))[:, None], np.arange(len(self.leaf))[None]
        node = np.zeros((len(x), len(self.leaf)), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.threshold[tree, node])
        return self.base + self.leaf[tree, node - (2**self.depth - 1)].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x))) if len(x) else np.zeros(0)


def fit(x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 4, rate: float = 0.1, bins: int = 64, ridge: float = 1.0, least: int = 20) -> Trees:
    """Boosted trees for labels 0 and 1; without rows of both labels a constant."""
    share = float(y.mean()) if len(y) else 0.5
    share = min(max(share, 1e-3), 1 - 1e-3)
    model = Trees(depth, float(np.log(share / (1 - share))))
    if not len(y) or len(np.unique(y)) < 2:
        return model
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)  # bin b: above cut b - 1, not above cut b
    margin = np.full(n, model.base)
    flat = binned + np.arange(m) * bins
    features, thresholds, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, threshold = np.zeros(2**depth - 1, np.int32), np.full(2**depth - 1, np.inf)
        for level in range(depth):
            width, first = 2**level, 2**level - 1
            slot = ((node - first)[:, None] * (m * bins) + flat).ravel()
            hist = [np.bincount(slot, np.repeat(v, m), width * m * bins).reshape(width, m, bins) for v in (g, h, np.ones(n))]
            left = [np.cumsum(v, axis=2) for v in hist]
            total = [v[:, :, -1:] for v in left]
            value = lambda a, b: a**2 / (b + ridge)
            gain = value(left[0], left[1]) + value(total[0] - left[0], total[1] - left[1]) - value(total[0], total[1])
            gain[(left[2] < least) | (total[2] - left[2] < least)] = -1
            best = gain.reshape(width, -1).argmax(axis=1)
            for k in range(width):
                j, b = divmod(int(best[k]), bins)
                if gain[k, j, b] > 1e-6 and b < len(cuts[j]):
                    feature[first + k], threshold[first + k] = j, cuts[j][b]
            f = feature[node]
            node = 2 * node + 1 + (x[np.arange(n), f] > threshold[node])
        node -= 2**depth - 1
        leaf = -rate * np.bincount(node, g, 2**depth) / (np.bincount(node, h, 2**depth) + ridge)
        margin = margin + leaf[node]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    model.feature, model.threshold, model.leaf = np.array(features), np.array(thresholds), np.array(leaves)
    return model


def _table(batches):
    for batch in portions(batches):
        x = [statistics(t) for t in texts_of(batch)]
        yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(x, pa.list_(pa.float64()))], ["y", "x"])


def train(docs: DataFrame, labels: DataFrame, most: int = 12_000) -> Trees:
    """Learn quality from labelled rows whose crc32(doc_id) mod 5 is not 0: those `most` of smallest hash of doc_id.

    Null labels are left out; a doc_id with several labels counts with their mean, rounded up."""
    known = labels.where(F.col("quality").isNotNull() & (hash_bucket("doc_id", 5) != 0)).groupBy("doc_id").agg(F.ceil(F.avg("quality")).cast("double").alias("y"))
    taken = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)  # at most `most` rows of 16 bytes
    rows = docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id").select("y", "text").mapInArrow(_table, "y double, x array<double>").toArrow()
    x = np.array(rows.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    return fit(x, np.array(rows.column("y").to_pylist(), float))


def classify(docs: DataFrame, model: Trees, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row (doc_id, text).

    Null texts are scored as empty ones; repeated rows are scored each; further columns are ignored."""

    def work(batches):
        for batch in portions(batches):
            texts = texts_of(batch)
            score = model.score(np.array([statistics(t) for t in texts], float).reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", (hash_bucket("doc_id", 5) == 0).alias("held_out"), "text").mapInArrow(work, "doc_id long, held_out boolean, score double, predicted int")
