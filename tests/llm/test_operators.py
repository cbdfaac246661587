"""The training-data operators against brute force, round trips and held-out accuracy, and on odd rows."""

import hashlib
import html
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from arborix.llm import decontaminate, html_text, langid, licenses, minhash, packing, quality, queries, suffix_dedup, token_counts, vector_graph
from arborix.llm.common import Scratch
from arborix.llm.suffix_dedup import Bwt, merge, repeated

DATA = "/root/testdata/sf0.001"
WORDS = "the of and thhetion onre inti erst ouea blely edha stnt tion".split()


def prose(r, n):
    return " ".join(r.choice(WORDS) + r.choice(["", "", "on", "re", "ty", "ol"]) for _ in range(n))


def docs_of(spark, texts, extra=False):
    rows = [(k, t, "en", "s", None) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", "1 AS score", "'x' AS words", "2 AS part") if extra else df


ODD = [None, "", " \n", "a", "!!!", "é", "x" * 5000, "und " * 2000, "same words here for all of us", "same words here for all of us", "<|endoftext|> it's ½"]


def all_rows(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


# ---- 1 ----------------------------------------------------------------------------------------------------------


def page(body, nav="<nav><a href=/>Home</a></nav>", tail="<footer>(c)</footer>"):
    return f"<html><head><title>T</title><script>var a='</p>'</script></head><body>{nav}<div class='ad'>Buy</div>{body}{tail}</body></html>"


def test_html(spark):
    art = "<article><h1>A &amp; B</h1><p><b>one<br><p>two  \n three<aside>side</aside><div id=comments>hi</div><form>f</form></article>"
    rows = [(1, "http://h/a/1", page(art)), (2, "http://h/a/2", page(art)), (3, "http://h/b", page("<p>line only here</p><p>shared tail</p>")), (4, "http://h/b2", page("<p>other</p><p>shared tail</p>")), (5, None, None), (6, "http://x/", ""), (1, "http://h/a/1", page(art))]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS part", "'k' AS key")).collect()
    assert len(got) == 7
    text = {r["page_id"]: r["text"] for r in got}
    assert text[1] == text[2] == "A & B\none\ntwo three" and text[3] == "line only here" and text[4] == "other" and text[5] == text[6] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_html_beside_article(spark):
    """Lines outside a page's article go only if its neighbour shares them."""
    rows = [(k, f"http://h/{k}", page(f"<div>lead {k}</div><article><p>teaser</p></article><div>body {k}</div><div>template</div>")) for k in (1, 2)]
    got = all_rows(html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")), "page_id")
    assert {k: r["text"] for k, r in got.items()} == {k: f"lead {k}\nteaser\nbody {k}" for k in (1, 2)}


def test_html_named_blocks(spark):
    """In an article, a name as a whole drops a block; one that only holds such a word is left to the neighbour."""
    kept = ["<div class='review-body'>r{k}</div>", "<div class='post-content side-by-side'>s{k}</div>", "<div class='related-work'>w{k}</div>", "<section id='comments-on-method'>c{k}</section>", "<header class='entry-header'><h1>Title{k}</h1></header>"]
    gone = ["<div class='comments'>x{k}</div>", "<div id='disqus_thread'>x{k}</div>", "<ul class='share-buttons x'><li>x{k}</li></ul>", "<div class='ad-slot'>x{k}</div>", "<div class='user-comments-list'>x{k}</div>", "<div class='related-work'>template</div>", "<div class='alert'>x{k}</div>"]
    rows = [(k, f"http://h/{k}", page("<article><p>a</p>" + "".join(x.format(k=k) for x in [*kept, *gone]) + "<p>b</p></article>")) for k in (1, 2)]
    got = all_rows(html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")), "page_id")
    assert all(got[k]["text"] == f"a\nr{k}\ns{k}\nw{k}\nc{k}\nTitle{k}\nb" for k in (1, 2))


def test_lcs():
    r = random.Random(1)
    for _ in range(200):
        a, b = [r.randint(0, 4) for _ in range(r.randint(0, 12))], [r.randint(0, 4) for _ in range(r.randint(0, 12))]
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        hit = html_text.shared(a, b, r.choice([1, 8, 1 << 29]))
        assert hit.sum() == table[-1, -1]
        it = iter(b)
        assert all(x in it for x, h in zip(a, hit) if h)


def test_html_markup():
    """Odd markup loses no text of an article, and hostile markup takes no more than linear time."""
    import time

    text = lambda body: "|".join(x for x, k in zip(*html_text.lines_of(f"<article>{body}</article>")) if k == 1)
    assert text("<p title=it's>one<p>It's two") == "one|It's two"
    assert text('<h2 class="side">head</h2><p class="notice board">p</p><div class="notice">cookies</div>') == "head|p"
    assert text("<p>if a<b then c</p><p>1 < 2 <3</p>") == "if a<b then c|1 < 2 <3"
    assert text("<p>x <math><mi>y</mi></math> <object>z</object></p>") == "x y z"
    assert text("<p a='>' b=\">\">q</p><!-- <p>no</p> --><![CDATA[a<b]]><?php x ?>") == "q|a<b"
    assert text("<div hidden>no</div><p data-hidden=1>yes</p>") == "yes"
    began = time.time()
    for bad in ('<b x="' * 50_000, '<a "' * 50_000, "<p" * 50_000, "<div>" * 50_000 + "</p>" * 50_000, "<p>" * 50_000, "<!--" * 50_000, "</b>" * 50_000):
        html_text.lines_of(bad)
    assert html_text.shared([1] * 4000, [1] * 3999 + [2]).sum() == 3999
    assert time.time() - began < 20


def test_html_pages(spark):
    import pyarrow.parquet as pq

    got = all_rows(queries.op1_html_text(spark, DATA), "page_id")
    for p in pq.read_table(f"{DATA}/pages.parquet").to_pylist():
        body = p["html"][p["html"].index("<article>") + 9 : p["html"].index("</article>")]
        blocks = (re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]+>", "", x))).strip() for x in re.split(r"</?(?:h1|p)>|<br>", body))
        assert got[p["page_id"]]["text"] == "\n".join(b for b in blocks if b)


# ---- 2 ----------------------------------------------------------------------------------------------------------


def test_token_counts(spark):
    vocabulary, pattern = queries._vocabulary("byte_bpe_50k.tiktoken"), queries._pattern()
    texts = [*ODD, "one\n\n\n two\nthree é\n", "a\n" * 50]
    rows = token_counts.count(docs_of(spark, texts, True), vocabulary, pattern).collect()
    encoder = token_counts.Encoder(vocabulary, pattern)
    for k, t in enumerate(texts):
        own = sorted((r for r in rows if r["doc_id"] == k), key=lambda r: r["section"])
        t = t or ""
        lines = t.split("\n")
        assert len(own) == len(lines) - (len(lines) > 1 and lines[-1] == "")
        assert sum(r["n_tokens"] for r in own) == own[0]["doc_tokens"] == len(encoder.encoding.encode_ordinary(t))
        assert own[0]["start_char"] == 0 and own[-1]["end_char"] == len(t)
        assert all(t[r["start_char"] : r["end_char"]].count("\n") <= 1 for r in own)
    owner, cross = token_counts.attribute(np.array([0, 3, 5]), np.array([3, 5, 9]), np.array([4, 6, 9]))
    unnamed = token_counts.count(spark.createDataFrame([(None, "a\nb"), (3, "c")], "doc_id long, text string"), vocabulary, pattern).collect()
    assert [r["doc_id"] for r in unnamed].count(None) == 2 and len(unnamed) == 3
    assert owner.tolist() == [0, 0, 2] and cross.tolist() == [False, True, True]  # a tie goes to the earlier section


# ---- 3 ----------------------------------------------------------------------------------------------------------


def test_decontaminate(spark):
    import duckdb

    r = random.Random(3)
    item = [f"w{r.randint(0, 10**6)}" for _ in range(30)]
    near = [w if k % 6 else "changed" for k, w in enumerate(item)]
    texts = [*ODD, "pre fix " + " ".join(item) + " end", " ".join(near), " ".join(item[:7]), " ".join(reversed(item)), " ".join(item[10:]), prose(r, 300)]
    bench = spark.createDataFrame([(0, " ".join(item)), (1, None), (2, "too short"), (0, " ".join(item))], "item_id long, text string")
    got = decontaminate.find(docs_of(spark, texts, True), bench)
    n = len(ODD)
    assert {(x["doc_id"], x["item_id"], x["n_match"]) for x in got.collect()} == {(n, 0, 30), (n + 1, 0, 25), (n + 4, 0, 20)}
    c = duckdb.connect()
    d, b = docs_of(spark, texts).toPandas(), bench.toPandas()  # noqa: F841
    c.execute("create view documents as select * from d")
    c.execute("create view benchmark as select * from b")
    want = c.execute(decontaminate.SQL)
    names = [x[0] for x in want.description]
    assert sorted(map(tuple, want.fetchall())) == sorted(tuple(x[k] for k in names) for x in got.collect())
    assert decontaminate.find(docs_of(spark, []), bench).count() == 0
    shuffled = decontaminate.find(docs_of(spark, texts, True), bench, broadcast_bytes=0)
    assert sorted(map(str, shuffled.collect())) == sorted(map(str, got.collect()))


def test_decontaminate_short_items(spark):
    """Items of few words: whole ones are found, those of less than four words only where a document holds nothing else."""
    import duckdb

    short = ["a b c d e f g", "one two three four", "yes no", "eight words are here and all must agree"]
    texts = [*short, "x x a b c d e f g y", "says one two three four five", "he said yes no", "eight words are here and all must differ", None, "", "a b c x e f g"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, f"0 0 {short[0]}"), (5, "other"), (3, short[1])]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(k, t) for k, t in enumerate([*short, "", None])], "item_id long, text string")
    want = {(0, 0), (1, 1), (2, 2), (3, 3), (4, 0), (5, 1), (None, 0), (3, 1)}
    for most in (0, 1 << 20):
        assert {(x["doc_id"], x["item_id"]) for x in decontaminate.find(docs, bench, most).collect()} == want
    c = duckdb.connect()
    d, b = docs.where("doc_id is not null").toPandas(), bench.toPandas()  # noqa: F841
    c.execute("create view documents as select * from d")
    c.execute("create view benchmark as select * from b")
    got = c.execute(decontaminate.SQL).fetchall()
    names = ["doc_id", "item_id", "n_match", "n_span", "n_item", "first_word"]
    assert sorted(got) == sorted(tuple(x[k] for k in names) for x in decontaminate.find(docs.where("doc_id is not null"), bench).collect())


def test_decontaminate_excerpts(spark):
    """Verbatim excerpts among common words are found whatever agrees by chance elsewhere on their diagonal."""
    r = random.Random(13)
    items = [prose(r, 50).split() for _ in range(20)]
    texts, want = [], set()
    for k, item in enumerate(items):
        for n in (13, 15, 18):
            a = r.randrange(16, 50 - n)
            around = [prose(r, 1) for _ in range(120)]
            around[30 + a : 30 + a + n] = item[a : a + n]
            around[30] = item[0]
            want.add((len(texts), k))
            texts.append(" ".join(around))
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]): x for x in decontaminate.find(docs_of(spark, texts), bench).collect()}
    assert want <= set(got) and len(got) < 1.1 * len(want)
    assert all(2 * x["n_match"] >= x["n_span"] and x["n_match"] >= 13 for x in got.values())
    clean = docs_of(spark, [prose(r, 300) for _ in range(40)])
    assert decontaminate.find(clean, bench).count() == 0


# ---- 4 ----------------------------------------------------------------------------------------------------------


def test_licenses(spark):
    texts = [*ODD, "CC-BY cc by; All RIGHTS reserved. Released under the MIT License.", "the GNU General Public License, all rights", "licensed under the apache license"]
    got = all_rows(licenses.scan(docs_of(spark, texts, True)))
    n = len(ODD)
    assert (got[n]["n_base"], got[n]["first_word"], got[n]["last_word"], got[n]["base_labels"]) == (3, 0, 4, "cc-by,reserved")
    assert got[n]["labels"] == "cc-by,mit,reserved" and got[n]["score"] == 1.0
    assert got[n + 1]["base_labels"] == "gpl" and got[n + 1]["n_base"] == 1
    assert got[n + 2]["labels"] == "apache-2.0" and 0.6 < got[n + 2]["score"] < 1
    assert got[0]["n_words"] == got[1]["n_words"] == 0 and got[0]["first_word"] is None


def test_license_labels():
    """Words that licences share give no label; whole texts, also with words changed or left out, give theirs."""
    scan = lambda t: licenses.scanner().scan(t)[5].split(",")
    assert scan("released under the") == scan("It was released under the terms that we like") == scan("without warranty of any kind, express or implied") == [""]
    for text, want in (("released under the GPL", "gpl"), ("Released under the Apache License", "apache-2.0"), ("released under the BSD terms", "bsd"), ("Released under the MIT License.", "mit"), ("Licensed under CC BY-NC-SA 4.0.", "cc-by,cc-by-nc-sa"), ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0")):
        assert ",".join(scan(text)) == want, text
    r = random.Random(17)
    for label, text in licenses.TEXTS:
        words = text.split()
        if len(words) > 40:
            changed = [w if r.random() > 0.04 else "other" for w in words if r.random() > 0.02]
            got = scan(f"{prose(r, 30)} {' '.join(changed)} {prose(r, 30)}")
            assert label in got and not {"mit", "bsd", "isc", "zlib", "boost", "apache-2.0", "unlicense"} & set(got) - {label}, (label, got)


def test_license_base(spark):
    """Base columns of a whole table against plain search."""
    import pyarrow.parquet as pq

    got = all_rows(queries.op4_license_scan(spark, DATA))
    for d in pq.read_table(f"{DATA}/documents.parquet").to_pylist():
        text = re.sub("[A-Z]", lambda m: m[0].lower(), d["text"] or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        at = sorted((i, label) for p, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
        row = got[d["doc_id"]]
        assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]) == (len(words), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({x for _, x in at})))
        assert set(row["base_labels"].split(",")) - {""} <= set(row["labels"].split(","))


def test_automaton():
    r = random.Random(4)
    seqs = [[r.randint(0, 3) for _ in range(r.randint(1, 14))] for _ in range(4)]
    a = licenses.Automaton(seqs)
    for _ in range(100):
        q = [r.randint(0, 4) for _ in range(20)]
        inside = lambda x, s: any(s[i : i + len(x)] == x for i in range(len(s) - len(x) + 1))
        for first, n, state in a.matches(q, 1):
            x = q[first : first + n]
            assert {k for k, s in enumerate(seqs) if inside(x, s)} == set(a.at[state]) != set()
            assert all(seqs[k][e - n + 1 : e + 1] == x for k, e in a.at[state].items())
            assert first + n == len(q) or not any(inside(q[first : first + n + 1], s) for s in seqs)


def test_longest_run(spark):
    """The run that two moving places find is the one that all pairs of places give."""
    r = random.Random(31)
    rows = [(k, sorted(r.sample(range(n * gap), n))) for k, (n, gap) in enumerate([(1, 1), (2, 9), *((r.randint(1, 40), r.choice([1, 2, 3, 5])) for _ in range(300))])]
    rows.append((len(rows), [*range(0, 900, 3), *range(900, 1500), *range(1500, 3000, 4)]))
    got = spark.createDataFrame(rows, "k int, same array<int>").select("k", decontaminate._longest_run(F.col("same")).alias("r")).select("k", "r.*").collect()
    for k, n, a in got:
        at = rows[k][1]
        want = max((y - x + 1, -x) for x in range(len(at)) for y in range(x, len(at)) if (y - x + 1) * 2 >= at[y] - at[x] + 1)
        assert (n, -a) == want, at


# ---- 5 ----------------------------------------------------------------------------------------------------------


def brute_dedup(raws, depth=200):
    count = Counter(x[i : i + depth] for x in raws for i in range(len(x) - depth + 1))
    for x in raws:
        cover = np.zeros(len(x) + 2, bool)
        for i in range(len(x) - depth + 1):
            if count[x[i : i + depth]] > 1:
                cover[i + 1 : i + depth + 1] = True
        kept = bytes(np.frombuffer(x, np.uint8)[~cover[1:-1]])
        yield len(x), int(cover.sum()), int((np.diff(cover.astype(int)) == 1).sum()), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("hot", [1000, 1])
def test_suffix_dedup(spark, hot):
    r = random.Random(5)
    passage, base = prose(r, 60), prose(r, 400)
    words = base.split()
    near = [" ".join(w if r.random() > 0.02 else "new" for w in words) for _ in range(4)]
    texts = [*ODD, base, base, *near, *(prose(r, 40) + passage + prose(r, 40) for _ in range(12)), passage[:199], "ab" * 600, prose(r, 30) + "é" * 150 + passage + "é" * 150, prose(r, 90)]
    got = all_rows(suffix_dedup.dedup(docs_of(spark, texts, True), hot=hot))
    for k, want in enumerate(brute_dedup([(t or "").encode() for t in texts])):
        assert (got[k]["n_bytes"], got[k]["n_removed"], got[k]["n_spans"], got[k]["kept_sha256"]) == want, k
    cut = all_rows(suffix_dedup.without_repeats(docs_of(spark, texts)))
    assert cut[0]["text"] is None and cut[1]["text"] == "" and cut[3]["text"] == "a" and set(cut[0]) == {"doc_id", "text", "lang", "source", "n_chars"}
    assert suffix_dedup.dedup(docs_of(spark, [])).count() == 0


def test_suffix_dedup_made_to_collide(spark):
    """A word whose letters follow the parity of their place's bits, and its complement, are equal under every polynomial modulo 2^64."""
    word = np.array([bin(k).count("1") % 2 for k in range(1024)], np.uint8)
    tail = np.frombuffer(prose(random.Random(6), 80).encode()[:199].replace(b"\xc3", b"x"), np.uint8)
    a, b = (np.concatenate((97 + (word ^ flip), tail)) for flip in (0, 1))
    one, two = (suffix_dedup.digests(x, np.array([0]), np.array([len(x)])) for x in (a, b))
    assert one[0] != two[0] and one[1] != two[1]
    texts = [x.tobytes().decode("latin-1") for x in (a, b)]
    texts += [texts[0][:700] + "!" + texts[1][:700], prose(random.Random(7), 60)]
    for hot in (1000, 1):
        got = all_rows(suffix_dedup.dedup(docs_of(spark, texts), hot=hot))
        for k, want in enumerate(brute_dedup([t.encode() for t in texts])):
            assert (got[k]["n_bytes"], got[k]["n_removed"], got[k]["n_spans"], got[k]["kept_sha256"]) == want, k


def test_suffix_dedup_odd_rows(spark):
    """Null and repeated ids, texts longer than a slice, runs of one letter, and extra columns of any name."""
    r = random.Random(15)
    passage = prose(r, 60)
    long = prose(r, 90_000)
    texts = [f"{prose(r, 50)} {passage} {prose(r, 50)}" for _ in range(4)] + [long, f"x {long[300_000:500_000]} y", "ab" * 300_000 + prose(r, 40)]
    ids = [None, None, 7, 7, 8, 9, 10]
    rows = [(i, t, len(t), 1.5, "s") for i, t in zip(ids, texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, k int, spans double, z string")
    cut = {x["text"]: x for x in suffix_dedup.without_repeats(df).collect()}
    want = list(brute_dedup([t.encode() for t in texts]))
    got = suffix_dedup.dedup(df).collect()
    assert sorted((x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in got) == sorted(want)
    assert sorted(hashlib.sha256(t.encode()).hexdigest() for t in cut) == sorted({w[3] for w in want})
    assert sorted(x["k"] for x in cut.values()) == sorted(len(t) for t in texts) and all((x["spans"], x["z"]) == (1.5, "s") for x in cut.values())


def test_suffix_dedup_constant(spark):
    """50 MB of one letter and of a short period are few equal chunks, not one task."""
    texts = ["a" * 50_000_000, "abc" * 1_000_000 + "d" * 150, "unique " + "".join(chr(97 + k * k % 23) for k in range(190))]
    rows = suffix_dedup.repeated_spans(docs_of(spark, texts))
    assert rows.selectExpr("sum(size(spans))").first()[0] < 100_000
    got = all_rows(suffix_dedup.dedup(docs_of(spark, texts)).drop("kept"))
    assert [(got[k]["n_removed"], got[k]["n_spans"]) for k in range(3)] == [(50_000_000, 1), (3_000_000, 1), (0, 0)]


def test_merged_transforms():
    r = random.Random(6)
    strings = [bytes(r.choice(b"ab\x00\xff") for _ in range(r.randint(0, 60))) for _ in range(40)] + [b"abab" * 20]
    for depth in (8, 20):
        count = Counter(s[i : i + depth] for s in strings for i in range(len(s) - depth + 1))
        want = [[i for i in range(len(s) - depth + 1) if count[s[i : i + depth]] > 1] for s in strings]
        assert [x.tolist() for x in repeated(strings, depth, shard=300)] == want
    b = Bwt([b"banana", b"ban"])
    suffixes = sorted((s[i:] + b"", k, i) for k, s in enumerate([b"banana", b"ban"]) for i in range(len(s) + 1))
    assert sorted(b.order.tolist()) == list(range(11)) and [bytes(x) for x, _, _ in suffixes] == [([b"banana", b"ban"][0 if o < 7 else 1])[o - (0 if o < 7 else 7) :] for o in b.order.tolist()]
    assert len(merge([b], 8)[0]) == 0


# ---- 6, 10 ------------------------------------------------------------------------------------------------------


def auc(score, y):
    rank = np.argsort(np.argsort(score)) + 1
    return (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())


def test_quality(spark):
    import pyarrow.parquet as pq

    sf = DATA.replace("0.001", "0.01")
    label = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    got = all_rows(queries.op6_quality(spark, sf))
    held = [d for d in label if zlib.crc32(str(d).encode()) % 5 == 0]
    assert all(got[d]["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d in got)
    assert auc(np.array([got[d]["score"] for d in held]), np.array([label[d] for d in held])) > 0.95
    assert all(got[d]["predicted"] == (got[d]["score"] >= 0.3) for d in got)
    model = quality.train(docs_of(spark, ODD), spark.createDataFrame([], "doc_id long, quality int"))
    odd = quality.classify(docs_of(spark, ODD, True), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r["score"] <= 1 for r in odd)


def test_boosting():
    r = np.random.default_rng(0)
    x = r.normal(size=(1500, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:1000], y[:1000])
    assert ((model.score(x[1000:]) > 0.5) == y[1000:]).mean() > 0.93


def test_language_learns_from_every_row(spark):
    """Prototypes and the least cosines are those of all 6,000 rows of a language, none left out."""
    r = random.Random(2)
    texts = ["".join(r.choice("abcdefgh ") for _ in range(r.randrange(3, 12))) + "z" for _ in range(6000)]
    docs = docs_of(spark, [*texts, None, "!"])
    names, protos = langid.fit(docs.repartition(5))
    whole = np.sum([langid.vector(t).astype(np.float64) for t in texts], axis=0)
    assert names == ["en"] and np.allclose(protos[0], whole / np.linalg.norm(whole), atol=1e-12)
    classes = {}
    for t in texts:
        classes.setdefault(langid.size_class(t), []).append(float(protos[0] @ langid.vector(t).astype(np.float64)))
    got = langid.floors(docs, names, protos, 0.0, low=0.05, slack=1.0)
    for k, found in classes.items():
        if len(found) >= 10:
            assert got[k] <= sorted(found)[int(0.05 * (len(found) - 1))] < got[k] + 2e-4, k
    assert max(map(len, classes.values())) > 1000


def test_language(spark):
    import pyarrow.parquet as pq

    sf = DATA.replace("0.001", "0.01")
    lang = {r["doc_id"]: r["lang"] for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()}
    got = all_rows(queries.op10_language_id(spark, sf))
    held = [d for d in lang if got[d]["held_out"]]
    assert np.mean([got[d]["lang_pred"] == lang[d] for d in held]) > 0.98
    odd = all_rows(langid.identify(docs_of(spark, ODD, True)))
    assert [odd[k]["lang_pred"] for k in range(5)] == ["und", "und", "und", "en", "und"]
    assert all(0 <= r["score"] <= 1 for r in odd.values())
    assert langid.identify(docs_of(spark, [])).count() == 0


def test_unlearned_languages(spark):
    """Language ID drops texts in languages and scripts that were not learned, and keeps nearly all others."""
    import corpus_pipeline

    r = random.Random(14)
    docs = spark.read.parquet(f"{DATA.replace('0.001', '0.01')}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    alien = ["Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
             "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä."]
    for a, b in ((0x430, 0x44F), (0x4E00, 0x9FFF), (0x3B1, 0x3C9), (97, 122)):
        alien += [" ".join("".join(chr(r.randint(a, b)) for _ in range(r.randint(2, 9))) for _ in range(200)) for _ in range(10)]
    more = spark.createDataFrame([(10**9 + k, t, None, "s", len(t)) for k, t in enumerate(alien)], docs.schema)
    kept = [x["doc_id"] for x in corpus_pipeline.language(spark, docs.unionByName(more), DATA).select("doc_id").collect()]
    assert all(d < 10**9 for d in kept) and len(kept) >= 0.99 * docs.count()


# ---- 7 ----------------------------------------------------------------------------------------------------------


def components_by_pairs(texts):
    """The smallest row that links of Jaccard 0.8 or more reach, from all pairs."""
    words = [re.findall(r"[a-z0-9\x80-\U0010ffff]+", (t or "").lower()) for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    parent = list(range(len(texts)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return {k: top(k) for k in range(len(texts))}


def test_minhash(spark):
    r = random.Random(7)
    base = [prose(r, 120).split() for _ in range(6)]
    texts = [*ODD]
    for b in base:
        texts.append(" ".join(b))
        texts += [" ".join(b).upper()] * 2
        for _ in range(14):
            own = list(b)
            for _ in range(r.randint(1, 4)):
                own[r.randrange(len(own))] = f"z{r.randint(0, 10**6)}"
            texts.append(" ".join(own))
    got = all_rows(minhash.near_duplicates(docs_of(spark, texts, True)))
    assert len(got) == len(texts) and {k: r["component_id"] for k, r in got.items()} == components_by_pairs(texts)
    assert all(r["kept"] == (r["component_id"] == k) for k, r in got.items())
    assert minhash.near_duplicates(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("rounds", [1, 4])
def test_minhash_large_buckets(spark, rounds):
    """Buckets of several components, all of them large, lose no link: documents share a long passage and come in pairs."""
    r = random.Random(8)
    shared = prose(r, 60)
    texts = []
    for _ in range(40):
        own = prose(r, 30).split()
        texts += [f"{shared} {' '.join(own)}", f"{shared} {' '.join(own[:-2])} end", " ".join(own)]
    got = all_rows(minhash.near_duplicates(docs_of(spark, texts), small=0, rounds=rounds))
    assert {k: r["component_id"] for k, r in got.items()} == components_by_pairs(texts)


def sets_of(spark, texts):
    rows = [(k, np.array([x], np.uint64).astype(np.uint32).view(np.int32).tolist()[0]) for k, t in enumerate(texts) for x in minhash.shingles([t])[1].tolist()]
    return spark.createDataFrame(rows, "id long, e int").groupBy("id").agg(F.collect_list("e").alias("set"))


@pytest.mark.parametrize("many", [2, 256])
def test_exact_pairs(spark, many):
    """The prefix filter keeps every pair of members of different components that reaches the threshold, and no pair of one component."""
    r = random.Random(9)
    shared, texts = prose(r, 80).split(), ["one two", "one two", "one two three four five"]
    for k in range(60):
        own = shared[: 20 + k] + [f"w{r.randint(0, 40)}" for _ in range(r.randint(0, 12))]
        texts += [" ".join(own), " ".join([*own, *prose(r, r.randint(1, 12)).split()])]
    component = {k: r.choice([0, k, k, k]) for k in range(len(texts))}
    marked = spark.createDataFrame([(key, k, c) for k, c in component.items() for key in (1, 2)], "key long, rep long, component long")
    scratch = minhash.Scratch(spark, "test")
    got = {tuple(sorted((x["rep"], x["pivot"]))) for x in minhash._exact(scratch, sets_of(spark, texts), marked, 0.8, many=many).collect()}
    sets = [set(minhash.shingles([t])[1].tolist()) for t in texts]
    want = {(i, j) for j in range(len(texts)) for i in range(j) if component[i] != component[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
    assert len(want) > 200 and want <= got and all(component[i] != component[j] for i, j in got)
    assert len(got) < len(texts) * (len(texts) - 1) // 2


def test_probability_jaccard():
    r = np.random.default_rng(1)
    ids = np.unique(r.integers(0, 2**63, 400, dtype=np.int64).astype(np.uint64))
    text = np.concatenate((np.zeros(300, int), np.ones(300, int)))
    sig = minhash.signatures(text, np.concatenate((ids[:300], ids[50:350])), np.ones(600), 2, 4096)
    assert abs((sig[0] == sig[1]).mean() - 250 / 350) < 0.04
    assert minhash.recall(32, 4, 0.8) > 0.9999


# ---- 8 ----------------------------------------------------------------------------------------------------------


def test_word_ids_when_full():
    """What a full memory keeps and forgets doesn't change a text's ids."""
    from tokenizers import Tokenizer

    r = random.Random(12)
    path = queries._vocabulary("word_bpe_49k.json")
    words, tokenizer = packing.WordIds(path, most=40), Tokenizer.from_file(path)
    for _ in range(60):
        texts = [" ".join([prose(r, 6), *(f"{prose(r, 1)}{r.choice('éàßx')}{r.randint(0, 99)}" for _ in range(r.randint(0, 20)))]) for _ in range(3)]
        assert [x.tolist() for x in words.encode(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(words.known) <= 80


def test_packing(spark):
    from tokenizers import Tokenizer

    r = random.Random(8)
    path = queries._vocabulary("word_bpe_49k.json")
    texts = [*ODD, *(prose(r, r.choice([3, 50, 200, 900, 4000])) + "." for _ in range(60)), "İ I ΑΣ it's O'Neil x² a\xa0b \x1c <|ENDOFTEXT|>"]
    rows = packing.pack(docs_of(spark, texts, True), path).collect()
    tokenizer = Tokenizer.from_file(path)
    for k, t in enumerate(texts):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        own = sorted((x for x in rows if x["doc_id"] == k), key=lambda x: x["piece"])
        assert [(x["start"], x["length"]) for x in own] == [(a, min(4096, len(ids) - a)) for a in range(0, len(ids), 4096)]
        assert all(zlib.crc32(ids[x["start"] : x["start"] + x["length"]].tobytes()) == x["ids_crc32"] for x in own)
    sequences: dict = {}
    for x in rows:
        sequences.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
    for s in sequences.values():
        s.sort()
        assert [o for o, _ in s] == np.cumsum([0, *(n for _, n in s[:-1])]).tolist() and sum(n for _, n in s) <= 4096
    assert len(sequences) <= -(-sum(x["length"] for x in rows) // 4096) + 1
    assert packing.pack(docs_of(spark, []), path).count() == 0


def best_fit_one_by_one(lengths: list[int], capacity: int) -> list[int]:
    """What is left of each sequence when pieces go one at a time, the longest first."""
    gaps: list[int] = []
    for n in sorted(lengths, reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is None:
            gaps.append(capacity - n)
        else:
            gaps[gaps.index(fit)] = fit - n
    return gaps


def test_best_fit_of_classes():
    r = random.Random(9)
    lengths = sorted((r.choice([1, 7, 30, 30, 64, r.randint(1, 100)]) for _ in range(400)), reverse=True)
    gaps = best_fit_one_by_one(lengths, 100)
    matches = packing.fill(Counter(lengths), {100: len(gaps)})
    fill = Counter()
    for rank, n, first, gap in sorted(matches, key=lambda m: -m[3]):
        for i in range(n):
            assert fill[first + i] == 100 - gap
            fill[first + i] += lengths[rank + i]
    assert sum(m[1] for m in matches) == 400 and max(fill.values()) <= 100 and sorted(100 - x for x in fill.values()) == sorted(gaps)
    assert packing.fill({9: 2, 5: 1}, {6: 1}) == [(2, 1, 0, 6)]  # ranks of what fits nowhere stay


def test_ranges_meet():
    # pieces left and gaps untouched by range: gaps take the nearest shorter range's pieces, no piece or gap twice
    runs, met = packing._meet([(0, 5, 0, 4, 0), (1, 2, 1, 8, 7), (2, 0, 4, 0, 9), (3, 1, 0, 20, 0)])
    assert met == 7
    assert runs == [(False, 0, 0, 0, 0, 1), (True, 1, 0, 0, 0, 1), (False, 1, 0, 1, 1, 1), (True, 2, 0, 1, 1, 1), (False, 0, 1, 4, 3, 2), (True, 2, 2, 3, 3, 1)]


@pytest.mark.parametrize("most", [10_000, 400, 200])
def test_best_fit_rounds(spark, most):
    """Many ranges or one: every piece once, no sequence over the capacity, gapless, near the fewest sequences."""
    r = random.Random(10)
    lengths = [*(r.choice([1, 3, 40, 100, 100, r.randint(1, 100), r.randint(1, 30)]) for _ in range(900)), *[51] * 60]
    table = spark.createDataFrame(list(enumerate(lengths)), "id long, length long")
    rows = packing.best_fit(Scratch(spark, "best-fit"), table, 100, most).collect()
    assert sorted(x["id"] for x in rows) == list(range(len(lengths)))
    sequences: dict = {}
    for x in rows:
        sequences.setdefault(x["sequence_id"], []).append((x["offset"], lengths[x["id"]]))
    for s in sequences.values():
        s.sort()
        assert [o for o, _ in s] == np.cumsum([0, *(n for _, n in s[:-1])]).tolist() and sum(n for _, n in s) <= 100
    assert len(sequences) <= len(best_fit_one_by_one(lengths, 100)) * 1.02 + 1


def test_best_fit_of_documents(spark):
    """The lengths of sf0.01's pieces in five ranges need at most 0.2 % more sequences than plain best fit, and one."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    scratch = Scratch(spark, "test-lengths")
    cut = scratch.save(packing.pieces(docs, queries._vocabulary("word_bpe_49k.json"), 4096, 1).withColumn("id", F.monotonically_increasing_id()))
    plain = len(best_fit_one_by_one([r["length"] for r in cut.select("length").collect()], 4096))
    for most in (500_000, 300):
        rows = packing.best_fit(scratch, cut.select("id", "length"), 4096, most)
        assert rows.count() == cut.count() and rows.select("sequence_id").distinct().count() <= plain * 1.002 + 1


# ---- 9 ----------------------------------------------------------------------------------------------------------


def test_vectors(spark):
    r = np.random.default_rng(10)
    base = r.normal(size=(150, 16))
    x = np.concatenate((base, base[:60] + r.normal(size=(60, 16)) * 0.08, base[:1].repeat(5, 0)))
    rows = [(k, [float(np.float32(a)) for a in v], int(k % 2) if k >= 210 or k < 0 else int((k if k < 150 else k - 150) % 3)) for k, v in enumerate(x)]
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [1.0] * 16, None), (904, [None] * 16, 1), (905, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS id", "2 AS v")
    got = all_rows(vector_graph.near_duplicates(df, shard=60), "vec_id")
    good = [(k, np.array(v, float), g) for k, v, g in rows if k < 900]
    u = np.array([v / np.linalg.norm(v) for _, v, _ in good])
    g = np.array([g for *_, g in good])
    link = (u @ u.T >= 0.93) & (g[:, None] == g[None])
    np.fill_diagonal(link, False)
    assert sum(got[k]["n_links"] for k in range(len(good))) >= 0.95 * link.sum() > 0
    assert all(got[k]["n_links"] <= link[k].sum() for k in range(len(good)))
    assert all(got[k]["n_links"] == 0 and got[k]["kept"] for k in range(900, 906)) and len(got) == len(rows)
    found, there = vector_graph.audit(df, vector_graph.near_duplicates(df, shard=60), every=5)
    assert 0.9 * there <= found <= there
    assert vector_graph.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_audited_shards():
    r = np.random.default_rng(14)
    base = r.normal(size=(60, 32))
    x = vector_graph._unit(np.concatenate((base, base[:1] + r.normal(size=(200, 32)) * 0.2)))
    link = np.argwhere(np.triu(x @ x.T >= 0.93, 1))
    for kept in (link, link[::2], link[:0]):
        assert sorted(map(tuple, vector_graph.audited(x, kept, 0.93, step=16).tolist())) == sorted(map(tuple, link.tolist()))


def test_vectors_repeated_ids(spark):
    """Every row is a vector: ids that repeat or are null, doubles that no float holds, and extra columns."""
    e = lambda k, by=1.0: [by if i == k else 0.0 for i in range(4)]
    near = [1.0, 0.1, 0.0, 0.0]
    rows = [(1, e(0, 1e-200), 5), (1, near, None), (1, near, 5), (7, e(0), 5), (None, e(0), 5), (None, e(2), 5), (3, e(2, 1e300), 5), (9, e(1), 5), (9, None, 5), (None, e(3), 6), (2, e(0), 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "0 AS id", "1 AS n", "2 AS row", "'x' AS name", "3 AS shard")
    got = sorted((tuple(r) for r in vector_graph.near_duplicates(df).collect()), key=str)
    want = [(1, 3, 1, True), (1, 0, 1, True), (1, 3, 1, True), (7, 3, 1, False), (None, 3, 1, False), (None, 1, 3, False), (3, 1, 3, True), (9, 0, 9, True), (9, 0, 9, True), (None, 0, None, True), (2, 0, 2, True)]
    assert got == sorted(want, key=str)


def test_crowded_shards_are_dealt_anew(spark):
    """With few centers at first, shards are crowded; centers of their own keep them small and the links found."""
    r = np.random.default_rng(13)
    base = r.normal(size=(700, 24))
    x = np.concatenate((base, base + r.normal(size=base.shape) * 0.1, base[:300] + r.normal(size=(300, 24)) * 0.1)).astype(np.float32)
    rows = spark.createDataFrame([(k, v, 1, 1) for k, v in enumerate(x.tolist())], "id long, v array<float>, label long, n long")
    found, counted = vector_graph.links(vector_graph.Scratch(spark, "test"), rows, 0.93, 100, 4, 24, levels=4)
    u = x / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    link = np.triu(u @ u.T >= 0.93, 1)
    pairs = {(p["a"], p["b"]) for p in found.collect()}
    assert pairs <= set(zip(*map(np.ndarray.tolist, np.nonzero(link)))) and len(pairs) >= 0.95 * link.sum() > 1000
    assert counted.count() == 0  # nothing was left to compare in blocks


def test_dense_vectors(spark):
    """Thousands of noisy near copies lose no link, beside other vectors that have few."""
    r = np.random.default_rng(11)
    base = r.normal(size=(401, 32))
    x = np.concatenate((base[:1] + r.normal(size=(3000, 32)) * 0.2, base[1:], base[1:] + r.normal(size=(400, 32)) * 0.1)).astype(np.float32)
    df = spark.createDataFrame([(k, v, 1) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<float>, label int")
    got = all_rows(vector_graph.near_duplicates(df, shard=100), "vec_id")
    u = x / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    link = u @ u.T >= 0.93
    np.fill_diagonal(link, False)
    n = np.array([got[k]["n_links"] for k in range(len(x))])
    assert link[:3000].sum() > 3000 * 1000 and n[:3000].tolist() == link[:3000].sum(axis=1).tolist()
    assert 0.9 * link[3000:].sum() <= n[3000:].sum() and (n <= link.sum(axis=1)).all()
    assert {got[k]["component_id"] for k in np.flatnonzero(link[0]).tolist()} == {0}


@pytest.mark.parametrize("block", [64, 4096])
def test_large_shards(spark, block):
    """Large shards that overlap count each pair once, whatever the blocks."""
    r = np.random.default_rng(12)
    base = r.normal(size=(12, 8))
    x = (base[r.integers(0, 12, 600)] + r.normal(size=(600, 8)) * 0.25).astype(np.float32)
    rows = spark.createDataFrame([(k, v, 1, k % 3 + 1) for k, v in enumerate(x.tolist())], "id long, v array<float>, label long, n long")
    found, counted = vector_graph.links(vector_graph.Scratch(spark, "test"), rows, 0.93, 20, 4, 4096, block)
    n, size, pairs = np.zeros(600, int), np.arange(600) % 3 + 1, found.collect()
    for a, b in pairs:
        n[a] += size[b]
        n[b] += size[a]
    for c in counted.collect():
        n[c["id"]] += c["others"]
    u = x / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    link = u @ u.T >= 0.93
    np.fill_diagonal(link, False)
    assert counted.count() > 0 and (n <= link @ size).all() and n.sum() >= 0.99 * (link @ size).sum()


# ---- pipeline ---------------------------------------------------------------------------------------------------


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, spark.createDataFrame(stage(spark, kept, DATA).collect(), docs.schema)
        assert kept.columns == names and kept.count() <= before.count(), name
    assert kept.count() > 0.5 * docs.count()
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in corpus_pipeline.run(spark, DATA).select("doc_id").collect()}
    odd = docs_of(spark, ODD)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, DATA).columns == names
        assert stage(spark, odd.limit(0), DATA).count() == 0, name


def test_pipeline_keeps_rows(spark):
    """Rows without a doc_id or that repeat one are documents of their own in near-dedup and suffix-array dedup."""
    import corpus_pipeline

    r = random.Random(16)
    texts = [prose(r, 80) for _ in range(4)]
    rows = [(i, t, "en", "s", len(t)) for i, t in zip((None, None, 5, 5), texts)] + [(6, texts[0], "en", "s", 1), (None, texts[1], "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    near = corpus_pipeline.near_dedup(spark, docs, DATA)
    assert sorted(x["text"] for x in near.collect()) == sorted(texts) and {x["doc_id"] for x in near.collect() if x["text"] == texts[0]} == {6}
    assert sorted(x["text"] for x in corpus_pipeline.passage_dedup(spark, near, DATA).collect()) == sorted(texts)
