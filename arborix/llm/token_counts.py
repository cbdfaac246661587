"""Token counts by offset-mapped attribution.

A whole document is encoded once. Every token's span of bytes follows from the lengths of the
tokens before it, so nothing is encoded again; tokens are joined with sections by their spans
(a search over sorted section bounds). A section is a line with the line feed that ends it.
A token that crosses a bound belongs to the section that holds most of its bytes, on a tie to
the earlier one; so the sections' counts add up to the document's.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import hold, portions, texts_of

SCHEMA = "doc_id long, section int, start_char long, end_char long, n_tokens long, n_crossing long, doc_tokens long"


class Encoder:
    def __init__(self, path: str, pattern: str):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
        self.encoding = tiktoken.Encoding("arborix", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, k in ranks.items():
            self.size[k] = len(token)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First and last byte (exclusive) of each token."""
        ids = np.array(self.encoding.encode_ordinary(text), np.int64)
        end = np.cumsum(self.size[ids])
        return end - self.size[ids], end


@lru_cache(maxsize=1)
def _encoder(path: str, pattern: str) -> Encoder:
    """One for each Python worker."""
    return Encoder(path, pattern)


def attribute(start: np.ndarray, end: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token its section and whether it crosses a bound; bounds are the sections' ends, ascending, the last the text's."""
    first, last = np.searchsorted(bounds, start, "right"), np.searchsorted(bounds, end - 1, "right")
    owner, cross = first.copy(), first != last
    for t in np.flatnonzero(cross).tolist():
        edges = np.concatenate(([start[t]], bounds[first[t] : last[t]], [end[t]]))
        owner[t] = first[t] + int(np.diff(edges).argmax())
    return owner, cross


def count(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """A row for each section of each row (doc_id, text).

    A null or empty text has one empty section without tokens; a null doc_id stays null and
    repeated rows are counted each."""

    def work(batches):
        encoder = _encoder(vocabulary, pattern)
        hold("encoder", _encoder.cache_clear)
        for batch in portions(batches, keep="encoder"):
            out: list[list[np.ndarray]] = [[] for _ in range(7)]
            for row, text in enumerate(texts_of(batch)):
                raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
                bounds = np.flatnonzero(raw == 10) + 1
                if not len(bounds) or bounds[-1] != len(raw):
                    bounds = np.append(bounds, len(raw))
                start, end = encoder.spans(text)
                owner, cross = attribute(start, end, bounds)
                chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))[bounds]
                n = len(bounds)
                for to, x in zip(out, (np.full(n, row), np.arange(n), np.concatenate(([0], chars[:-1])), chars, np.bincount(owner, minlength=n), np.bincount(owner[cross], minlength=n), np.full(n, len(start))), strict=True):
                    to.append(x)
            names = ["doc_id", "section", "start_char", "end_char", "n_tokens", "n_crossing", "doc_tokens"]
            columns = [np.concatenate(x) if x else np.empty(0, np.int64) for x in out]
            arrays = [pa.array(c.astype(np.int32 if k == "section" else np.int64)) for k, c in zip(names, columns, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(arrays[0]), *arrays[1:]], names)

    return docs.select("doc_id", "text").mapInArrow(work, SCHEMA)
