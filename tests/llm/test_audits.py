"""Source divergence, WARC archives and cross-tokenizer alignment against brute force, and on odd rows."""

import base64
import glob
import hashlib
import os
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from arborix.llm import alignment, divergence, warc
from arborix.llm.common import Scratch

# ---- 11 ---------------------------------------------------------------------------------------------------------


def divergence_by_hand(rows, top=200, least=3):
    rows = [tuple(x or "" for x in r) for r in rows]
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(fold)) for t, _, _ in rows]
    out = []
    for lang in {r[1] for r in rows}:
        docs = Counter(t for r, w in zip(rows, words) if r[1] == lang for t in set(w))
        kept = [t for t, n in docs.items() if n >= least]
        count = defaultdict(Counter)
        for r, w in zip(rows, words):
            if r[1] == lang:
                count[r[2]].update(t for t in w if t in set(kept))
        whole = sum(count.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in count.items()}, share(whole)
        f = lambda a, b: (a - b) * (a - b) // b
        for s in count:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in count if o != s))
            terms = sorted((-f(p[s][t], q[t]), t.encode(), t) for t in kept if count[s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, part, name, -v, k + 1) for part, found in (("pair", pairs), ("term", terms)) for k, (v, _, name) in enumerate(found)]
    return sorted(out)


SOURCES = [("the cat sat on The mat; the end", "en", f"s{k % 5}") for k in range(12)] + [(f"word{'abc'[k % 3]} été ÉTÉ x x{'y' * (k % 2)} rare{k} {'zeta ' * (k % 4)}", "en", f"s{k % 7}") for k in range(40)]
SOURCES += [(None, None, None), ("", "fr", "a"), ("un", "fr", "b"), ("deux un", "fr", None), ("123 !!", "de", "x"), ("q", "xx", "only"), ("tie tie2", "t", "a"), ("tie tie2", "t", "b"), ("tie tie2", "t", "c"), ("tie tie2", "t", "c")]


@pytest.mark.parametrize(("seats", "cell_rows"), [(6, 200_000), (3, 4), (2, 1)])
def test_divergence(spark, seats, cell_rows):
    df = spark.createDataFrame(SOURCES, "text string, lang string, source string").selectExpr("*", "1 AS n", "'k' AS term", "2 AS block").repartition(3)
    got = divergence.audit(df, seats=seats, cell_rows=cell_rows).select("lang", "source", "part", "item", "value", "rank").collect()
    assert sorted(map(tuple, got)) == divergence_by_hand(SOURCES)


def test_divergence_empty(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_divergence_top(spark):
    got = divergence.audit(spark.createDataFrame(SOURCES, "text string, lang string, source string"), top=2).where("part = 'term'")
    assert sorted(tuple(r) for r in got.select("lang", "source", "part", "item", "value", "rank").collect()) == [r for r in divergence_by_hand(SOURCES, 2) if r[2] == "term"]


def test_shares_are_exact():
    r = np.random.default_rng(1)
    for total in (1, 7, 999_999_937, 3_000_000_019, 9_000_000_000_000_000):
        count = r.integers(0, total, 200)
        assert divergence.shares(count, total).tolist() == [1 + 10**9 * (c + 1) // total for c in count.tolist()]


def test_rounds_meet_once():
    for n in range(1, 9):
        met = [frozenset(p) for pairs in divergence.rounds(n) for p in pairs]
        assert len(met) == len(set(met)) == n * (n - 1) // 2 and all(len({s for p in pairs for s in p}) == 2 * len(pairs) for pairs in divergence.rounds(n))


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(divergence, "_LONG", 7)
    raw = "Aé bcd efghijklmnop q  rs!".encode()
    assert [t for part in divergence._terms(raw) for t in part] == "aé bcd efghijklmnop q rs".encode().split()


# ---- 12 ---------------------------------------------------------------------------------------------------------

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77:x>\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
PAGES = [(1, "http://a/WARC/1.0\r\n", "x" + FAKE + FAKE + "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5000\r\n\r\nzz"), (2, None, None), (3, "u", ""), (4, "WARC/1.", "WARC/1."), (5, "é WARC/1.WARC/1.", "\r\n\r\nWARC/1.1\r\nContent-Length: 3"), (6, "u", "WARC/1.\r\n\r\nWARC/1.1\r\n")]
PAGES += [(7, "u", "WARWARC/1.1\r\nWARC/WARC/1.")] * 2 + [(None, "v", "é" * 3000 + FAKE), (9, "v", "é" * 3000 + FAKE), (None, "v", "same"), (None, "v2", "same")] + [(100 + k, "u", ("q" * (k % 7) + "WARC/1."[: k % 8]) * 9 + FAKE * (k % 3)) for k in range(24)]


def archive_by_hand(pages, least=0):
    same, out = defaultdict(list), []
    for nth, (page, url, text) in enumerate(pages):
        raw = (text or "").encode()
        same[raw if len(raw) >= least else (nth, raw)].append((-(10**18) if page is None else page, url or "", page, raw))
    for own in same.values():
        own.sort(key=lambda x: x[:2], reverse=True)
        out += [(p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if k else "response", own[0][2] if k else None) for k, (_, _, p, raw) in enumerate(own)]
    return sorted(map(repr, out))


def pages_of(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS payload", "'x' AS digest", "2 AS nth")


@pytest.mark.parametrize("least", [0, 20])
def test_archives(spark, least):
    got = warc.round_trip(pages_of(spark), least)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == archive_by_hand(PAGES, least)


def test_archives_empty(spark):
    assert warc.round_trip(pages_of(spark, [])).count() == 0


def test_archives_in_splits(spark):
    """One plain file read in splits that cut headers, magics and payloads, its texts, and the file cut off within its last record."""
    path = f"{Scratch(spark, 'test-warc').base}/plain"
    warc.write(pages_of(spark).repartition(1), path, compression="none")
    (file,) = glob.glob(f"{path.removeprefix('file:').replace('//', '/')}/*.txt")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "777")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        records = warc.index(spark, path).orderBy("start").collect()
        assert len(records) == len(PAGES) and records[-1]["end"] == os.path.getsize(file)
        assert all(a["end"] == b["start"] for a, b in zip(records, records[1:]))
        texts = Counter((r["target_uri"], bytes(r["payload"])) for r in warc.payloads(spark, path).collect())
        line = lambda u: (u or "").replace("\r", "%0D").replace("\n", "%0A") or None
        assert set(x for _, x in texts) == {(h or "").encode() for _, _, h in PAGES} and {u for u, _ in texts} <= {line(u) for _, u, _ in PAGES}
        whole = open(file, "rb").read()
        open(file, "wb").write(whole[: records[-1]["end"] - 30])
        os.remove(f"{os.path.dirname(file)}/.{os.path.basename(file)}.crc")
        assert warc.index(spark, path).count() <= len(PAGES) - 1
        assert sorted(r["start"] for r in warc.index(spark, path).collect()) == [r["start"] for r in records if r["end"] <= len(whole) - 1]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_pointer_jumping(spark):
    links = [("f", 0, 5), ("f", 5, 9), ("f", 9, 12), ("f", 12, 40), ("f", 6, 9), ("f", 20, 21), ("f", 21, 40), ("g", 3, 7), ("h", 0, 1)]
    scratch = Scratch(spark, "test-jumps")
    got = warc.reachable(scratch, scratch.save(spark.createDataFrame(links, "file string, start long, next long")))
    assert sorted(map(tuple, got.collect())) == [("f", 0), ("f", 5), ("f", 9), ("f", 12), ("h", 0)]


# ---- 13 ---------------------------------------------------------------------------------------------------------

PATHS = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"))
TEXTS = ["the cat sat", "the cat sat on the mat", None, "", " ", "  two  spaces ", "tab\tand\r\nlines\n\n", "▁ odd", "<|endoftext|> <s> <0x41>", "é́ ﬁ 東京 😀 ​\x00", "a", "a", "x" * 3000, "naïve coöperation; (unbelievably) 12345,67", "word " * 500]


def alignment_by_hand(texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=PATHS[2])
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(c): c for c in printed} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in printed)}
    bytes_a = lambda k: bytes(byte_of[c] for c in a.id_to_token(k))
    bytes_b = lambda k: bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode()
    groups = []
    for text in texts:
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        if not text or b"".join(map(bytes_a, ids_a)) != (" " + text).encode() or b"".join(map(bytes_b, ids_b)) != (" " + text).encode():
            groups.append(None)
            continue
        ends = []
        for ids, size in ((ids_a, bytes_a), (ids_b, bytes_b)):
            at, own = 0, {}
            for k, i in enumerate(ids):
                at += len(size(i))
                own[at] = k + 1
            ends.append(own)
        both = sorted(set(ends[0]) & set(ends[1]))
        groups.append([(ids_a[ends[0].get(p, 0) : ends[0][q]], ids_b[ends[1].get(p, 0) : ends[1][q]]) for p, q in zip([0, *both], both)])
    count = Counter((x[-1], y[-1]) for g in groups for x, y in g or [])
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    out = []
    for k, g in enumerate(groups):
        if g is None:
            out.append((k, 0, 0, 0, 0, 0, 0, ""))
            continue
        pairs = [(x[-1], y[-1]) for x, y in g]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((k, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(g), sum(count[p] == most[p[1]] for p in pairs), sum(count[p] for p in pairs), hashlib.sha256(text.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("most", [8_000_000, 1, 200])
def test_alignment(spark, most):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").selectExpr("*", "1 AS chunk", "'k' AS key", "2 AS count").repartition(2)
    got = alignment.align(df, *PATHS, most=most)
    assert sorted(map(tuple, got.collect())) == alignment_by_hand(TEXTS)


def test_alignment_odd_rows(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), *PATHS).count() == 0
    got = alignment.align(spark.createDataFrame([(None, "one"), (1, "one"), (1, "one"), (2, None)], "doc_id long, text string"), *PATHS).collect()
    assert len(got) == 4 and Counter(r["doc_id"] for r in got) == {None: 1, 1: 2, 2: 1} and all(r["count_sum"] == (3 if r["n_a"] else 0) for r in got)


def test_groups_with_equal_hashes(monkeypatch):
    a, b = np.array([1, 2, 3, 1, 2, 9], np.int32), np.array([7, 7, 8, 7], np.int32)
    first_a, n_a, first_b, n_b = np.array([0, 2, 3, 5]), np.array([2, 1, 2, 1]), np.array([0, 1, 2, 3]), np.array([1, 1, 1, 1])
    for zero in (False, True):
        if zero:
            monkeypatch.setattr(alignment, "mix", lambda x: x * np.uint64(0))
        one, kind = alignment.intern(a, b, first_a, n_a, first_b, n_b)
        assert len(one) == 4 and len(set(kind.tolist())) == 4 and all(kind[k] == i for i, k in enumerate(one))
    a2 = np.array([1, 2, 3, 1, 2, 3], np.int32)
    assert len(alignment.intern(a2, np.array([7, 7, 7, 7], np.int32), first_a, n_a, first_b, n_b)[0]) == 2
