"""Licence scans with a generalised suffix automaton over the tokens of licence templates.

The automaton holds every run of tokens of every template. A file is streamed through it once and
gives matching statistics (the longest template run that ends at each word); maximal matches of
`least` words or more are chained in order per template into covered template spans, and a
template whose covered share reaches `share` gives its label if a match of the chain tells it apart: a run
of words that stands in templates of one family of licences only. Words that many licences
share ("released under the", "without warranty of any kind") give no label.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import portions, texts_of
from .license_texts import FAMILY, LEADS, NAMES, TEXTS

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: The phrases and labels of the base.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Label and text of each template: whole licences and notices, and one-line notices of each name, with and without "the".
TEMPLATES = [*TEXTS, *((label, f"{lead} {the}{name}") for label, name in NAMES for lead in LEADS for the in ("", "the "))]
SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans string"


class Automaton:
    """A suffix automaton of several token sequences; at[state] has for each sequence the first end of the state's runs."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.at = [-1], [0], [{}]
        for k, sequence in enumerate(sequences):
            last = 0
            for i, token in enumerate(sequence):
                last = self._extend(last, token)
                state = last
                while state > 0 and k not in self.at[state]:
                    self.at[state][k] = i
                    state = self.link[state]

    def _new(self, length: int, link: int, moves: dict, at: dict) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.at.append(at)
        return len(self.next) - 1

    def _split(self, p: int, q: int, token: int) -> int:
        if self.length[p] + 1 == self.length[q]:
            return q
        clone = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]), dict(self.at[q]))
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, token: int) -> int:
        if token in self.next[last]:
            return self._split(last, self.next[last][token], token)
        new, p = self._new(self.length[last] + 1, 0, {}, {}), last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.next[p][token], token)
        return new

    def matches(self, tokens: list[int], least: int) -> list[tuple[int, int, int]]:
        """(first token, length, state) of each maximal match of `least` tokens or more."""
        out, state, n = [], 0, 0
        for i, token in enumerate(tokens):
            was = state, n
            while state and token not in self.next[state]:
                state = self.link[state]
                n = self.length[state]
            if token in self.next[state]:
                state, n = self.next[state][token], n + 1
            else:
                state, n = 0, 0
            if n <= was[1] and was[1] >= least:
                out.append((i - was[1], was[1], was[0]))
        if n >= least:
            out.append((len(tokens) - n, n, state))
        return out


class Scanner:
    def __init__(self, templates=None, least: int = 3, share: float = 0.6, gap: int = 40):
        self.templates = list(dict.fromkeys((label, tuple(w.decode() for w in WORD.findall(text.lower().encode()))) for label, text in (templates or TEMPLATES)))
        self.family = [FAMILY.get(label, label) for label, _ in self.templates]
        self.least, self.share, self.gap = least, share, gap
        phrases = [(p.split(), label) for p, label in BASE.items()]
        self.ids = {w.encode(): k for k, w in enumerate(dict.fromkeys(w for words in [*(t for _, t in self.templates), *(p for p, _ in phrases)] for w in words))}
        self.base = [([self.ids[w.encode()] for w in p], label) for p, label in phrases]
        coded = [[self.ids[w.encode()] for w in t] for _, t in self.templates]
        self.automaton = Automaton(coded)
        self.telling = [len({self.family[k] for k in at}) == 1 for at in self.automaton.at]
        self.pair = np.zeros((len(self.ids) + 1, len(self.ids) + 1), bool)
        for t in coded:
            self.pair[t[:-1], t[1:]] = True

    def _chain(self, found: list[tuple[int, int, int]]) -> dict[int, tuple[int, list]]:
        """Per template with a telling match the covered words of the best chain, and its (first word, words, template place, telling).

        A match can follow any that ends within `gap` words before it; ends ascend with starts, so no other is looked at."""
        per: dict[int, list] = {}
        told = {k for _, _, state in found if self.telling[state] for k in self.automaton.at[state]}
        for first, n, state in found:
            for k, end in self.automaton.at[state].items():
                if k in told:
                    per.setdefault(k, []).append((first, n, end - n + 1, self.telling[state]))
        out = {}
        for k, hits in per.items():
            hits.sort()
            best = []
            for i, (first, n, place, _) in enumerate(hits):
                value, back = n, -1
                for j in range(i - 1, -1, -1):
                    f, m, p, _ = hits[j]
                    if first - (f + m) > self.gap:
                        break
                    extra = n - max(0, f + m - first, p + m - place)
                    if f < first and p < place and extra > 0 and best[j][0] + extra > value:
                        value, back = best[j][0] + extra, j
                best.append((value, back))
            i = max(range(len(best)), key=lambda x: (best[x][0], -x))
            value, spans = best[i][0], []
            while i >= 0:
                spans.append(hits[i])
                i = best[i][1]
            out[k] = value, spans[::-1]
        return out

    def scan(self, text: str) -> tuple:
        words = WORD.findall(text.encode("utf-8", "replace").lower())
        get, other = self.ids.get, len(self.ids)
        ids = np.fromiter((get(w, other) for w in words), np.int64, len(words))
        places, labels = [], set()
        for phrase, label in self.base:
            n = len(ids) - len(phrase) + 1
            if n > 0:
                hit = ids[:n] == phrase[0]
                for i, w in enumerate(phrase[1:], 1):
                    hit = hit & (ids[i : n + i] == w)
                if hit.any():
                    labels.add(label)
                    places.append(np.flatnonzero(hit))
        at = np.sort(np.concatenate(places)) if places else np.empty(0, np.int64)
        found = []
        if len(ids) > 1:
            pair = np.concatenate(([False], self.pair[ids[:-1], ids[1:]], [False])).astype(np.int8)
            edge = np.diff(pair)
            for a, b in zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) + 1).tolist(), strict=True):
                if b - a >= self.least:  # a longer match lies within a run of words that follow each other in some template
                    found += [(a + first, n, state) for first, n, state in self.automaton.matches(ids[a:b].tolist(), self.least)]
        score, more, spans = 0.0, set(), []
        for k, (value, chain) in sorted(self._chain(found).items()):
            covered = min(1.0, value / len(self.templates[k][1]))
            if not any(tells for *_, tells in chain):
                continue
            score = max(score, covered)
            if covered >= self.share:
                more.add(self.templates[k][0])
                spans.append(f"{self.templates[k][0]}@{chain[0][0]}-{max(f + m for f, m, *_ in chain)}")
        return len(words), len(at), int(at[0]) if len(at) else None, int(at[-1]) if len(at) else None, ",".join(sorted(labels)), ",".join(sorted(labels | more)), score, ";".join(dict.fromkeys(spans))


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) of every row (doc_id, text).

    A null or empty text has no words, no labels and score 0; repeated rows are scanned each; of equal
    chains the earliest counts."""

    def work(batches):
        s = scanner()
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.string()]
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
        for batch in portions(batches):
            rows = [s.scan(t) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds))], ["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(work, SCHEMA)
