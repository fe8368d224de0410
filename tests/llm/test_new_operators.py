"""Whitening, periodic runs and main texts against plain computations."""

import hashlib
import html as markup
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscope.llm import periodic_runs, queries, site_tree, whitening

SHA = lambda b: hashlib.sha256(b).hexdigest()


# whitening


@pytest.mark.parametrize("n", [1, 2, 3, 7, 40])
def test_symmetric_qr(n):
    rng = np.random.default_rng(n)
    for a in (rng.normal(size=(n, n)), np.ones((n, n)), np.diag(rng.integers(0, 3, n).astype(float)), np.zeros((n, n))):
        a = a @ a.T
        values, vectors = whitening.symmetric_qr(a)
        size = max(values[0], 1e-30)
        assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() < 1e-13 * size + 1e-28
        assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-13 and np.abs(a @ vectors - vectors * values).max() < 1e-13 * size + 1e-28


def test_states_merge_to_one_pass():
    rng = np.random.default_rng(3)
    x = rng.normal(5, 2, (90, 6)) * [1, 2, 3, 4, 5, 1000]
    parts, whole = [whitening.State.of(6) for _ in range(4)], whitening.State.of(6)
    for i, row in enumerate(x):
        parts[min(i // 20, 2)].add(row)  # one stays empty
    for p in parts:
        whole.merge(whitening.State.unpacked(**p.packed().to_pylist()[0]))
    assert whole.n == 90 and np.allclose(whole.mean, x.mean(axis=0), rtol=1e-14)
    assert np.allclose(whole.scatter / 90, np.cov(x.T, bias=True), rtol=1e-12)


def plainly(vectors):
    """Model of distinct fixed-point vectors by numpy alone."""
    x = np.floor(np.array(vectors, np.float64) * 256).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    values, axes = np.linalg.eigh(np.cov((fit - s / n).T, bias=True))
    values, axes = values[::-1], axes[:, ::-1]
    return n, [sum(int(v) ** 2 for v in n * r - s) for r in x], (x - s / n) @ axes[:, :4] / np.sqrt(values[:4]), values[:4] / values.sum()


def test_whitening_query(spark, sf):
    got = queries.queries()["op11_embedding_whitening"](spark, sf).orderBy("vec_id", "component").toPandas()
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").toPandas()
    n, deviations, white, explained = plainly(list(rows["embedding"]))
    assert len(got) == 4 * len(rows) and set(got["n"]) == {n}
    assert got["deviation"].tolist() == [d for d in deviations for _ in range(4)]
    mine = got["whitened"].to_numpy().reshape(-1, 4)
    assert np.abs(mine * np.sign((mine * white).sum(axis=0)) - white).max() < 1e-9
    assert np.allclose(got["explained"].to_numpy()[:4], explained, rtol=1e-10) and got["identity_error"].max() < 1e-10 and got["identity_error"].nunique() == 1


def test_whitening_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 1.0, -0.001]), (2, [0.25, 2.0, 3.0]), (2, [0.25, 2.0, 3.0]), (None, [-1.0, 0.0, 1e30]), (5, [1.0, 1.0, 1.0])]
    bad = [(6, None), (7, []), (8, [1.0, None, 2.0]), (9, [nan, 1.0, 1.0]), (10, [1.0, inf, 1.0]), (11, [1.0, 2.0]), (12, [-inf, 0.0, 0.0])]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("x", "n", "component", "id", "v", "copies")})
    got = whitening.whitened(df, whitening.fit(df)).collect()
    assert len(got) == 15 and {r["n"] for r in got} == {4}
    assert {r["vec_id"] for r in got} == {1, 2, None, 5} and all(r["deviation"] is None for r in got)  # 1e30 fills 64 bits
    # fewer vectors than dimensions: the last component has no variance
    few = df.where("vec_id in (1, 2)")
    got = whitening.whitened(few, whitening.fit(few)).collect()
    assert [r["whitened"] is None for r in got if r["vec_id"] == 1] == [False, True, True] and len(got) == 9 and all(r["deviation"] is not None for r in got)
    one = df.where("vec_id = 5")
    got = whitening.whitened(one, whitening.fit(one)).collect()
    assert [(r["whitened"], r["explained"], r["deviation"], r["identity_error"]) for r in got] == [(None, None, 0, None)] * 3
    for nothing in (df.where("vec_id > 5 and vec_id <> 11"), df.limit(0)):
        out = whitening.whitened(nothing, whitening.fit(nothing))
        assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_merge_beyond_one_round(spark):
    x = np.random.default_rng(1).integers(-9, 9, (400, 5))
    df = spark.createDataFrame([([int(v) for v in r],) for r in x], "x array<bigint>").repartition(40)
    state = whitening.scattered(df, 5)
    assert state.n == 400 and np.allclose(state.scatter / 400, np.cov(x.T, bias=True))
    assert [int(h) * 2**32 + int(v) for h, v in zip(state.high, state.low, strict=True)] == x.sum(axis=0).tolist()


# periodic runs


def every_run(w):
    """All runs by every period and place."""
    n, out = len(w), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i + q - a >= max(24, 3 * q):
                out.setdefault((a, i + q), q)
    return sorted((a, b - a, q) for (a, b), q in out.items())


def repetitive(rnd, n, k):
    if n <= 3 or rnd.random() < 0.2:
        return [rnd.randrange(k) for _ in range(n)]
    m = rnd.randint(1, max(1, n // 2))
    if rnd.random() < 0.5:
        return (repetitive(rnd, m, k) * (n // m + 1))[:n]
    return repetitive(rnd, m, k) + repetitive(rnd, n - m, k)


def test_runs_of_sequences():
    rnd, some = random.Random(5), 0
    for t in range(1500):
        w = repetitive(rnd, rnd.randint(0, 160 if t % 10 else 500), rnd.choice([1, 2, 2, 3, 5, 40]))
        if w and rnd.random() < 0.3:
            w[rnd.randrange(len(w))] = 1
        want = every_run(w)
        some += len(want)
        assert periodic_runs.runs_of(np.array(w, np.int64)) == want
    assert some > 500


@pytest.mark.parametrize("w", [[1] * 60_000, ([1] * 10 + [2]) * 6_000, list(range(20_000)) * 3 + [5]], ids=["one word", "blocks", "long period"])
def test_long_sequences(w):
    (start, length, period), *rest = periodic_runs.runs_of(np.array(w, np.int64))
    assert (start, length, rest) == (0, len(w) - (w[-1] == 5), []) and period == {60_000: 1, 66_000: 11}.get(len(w), 20_000)


def rewritten(words, doc_id):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a, out = g % n, list(words)
    p = 1 + (n - a) // (3 + g % 8)
    for i in range(a, n):
        out[i] = words[a + (i - a) % p]
    return out


def test_runs_query(spark, sf):
    got = {r["doc_id"]: r for r in queries.queries()["op12_periodic_runs"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    seen = 0
    for doc_id, text in docs:
        words = rewritten(re.findall(r"[^\x20\x09-\x0D]+", text or ""), doc_id)
        if len(words) > 4_000:
            continue  # the plain way takes time by the square
        runs = every_run(words)
        kept = [w for i, w in enumerate(words) if not any(a + q <= i < a + n for a, n, q in runs)]
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        seen += bool(runs)
        r = got[doc_id]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == SHA("".join(f"{a},{n},{q}\n" for a, n, q in runs).encode()) and r["collapsed_sha256"] == SHA(" ".join(kept).encode())
    assert seen > 5


def test_runs_of_odd_texts(spark):
    said = "a b c " * 20
    texts = [None, "", " \n\t", "one", said, said, "x y " * 24, "z " * 200_000, "é日" * 100_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, said), (4, said)], "doc_id long, text string").withColumn("key", F.lit(1))
    got = periodic_runs.collapsed(df).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 11 and [by[i]["n_words"] for i in range(4)] == [0, 0, 0, 1] and all(by[i]["runs"] == [] for i in (0, 1, 2, 3, 8))
    assert [tuple(r) for r in by[4]["runs"]] == [(0, 60, 3)] and by[4]["collapsed"] == "a b c" and by[None]["collapsed"] == "a b c"
    assert by[6]["collapsed"] == "x y" and by[7]["runs"][0]["length"] == 200_000 and by[7]["collapsed"] == "z"
    assert by[0]["runs_sha256"] == SHA(b"") == by[0]["collapsed_sha256"]
    assert periodic_runs.collapsed(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="named like results"):
        periodic_runs.collapsed(df.withColumn("runs", F.lit(1)), keep=("doc_id", "runs"))
    queried = queries.repeated_from([b"a"], None)
    assert queried == [b"a"]


# main texts


CASES = {
    "a form around the page": ("<body><form><main><h1>T</h1><p>x y</p></main></form>", "T\nx y"),
    "comments, also as articles": ('<article><h1>T</h1><p>a<br>b</p><aside>s</aside><div class="comments"><p>c</p></div></article><section id="comments"><article class="comment"><p>z</p></article></section>', "T\na b"),
    "no marked text": ('<div class=header>h</div><div>text <span class="ad">buy <span>now</span></span> more</div><ul><li>one<li>two</ul><div id=footer>f</div>', "text more\none\ntwo"),
    "header of an article": ("<article><header><h1>T</h1><p>by</p></header><p>x</p><footer>f</footer></article><footer>ff", "T\nby\nx"),
    "unclosed and cut": ('<p>abc <b>d</b>e<p>fgh <a href="x', "abc de\nfgh"),
    "scripts": ('<p>a</p><script>if (a<b) "</p>"</script><p>b</p><script>never', "a\nb"),
    "comments of the markup": ("<p>a<!-- x > <p>no</p> --> b</p><!--> c<!-- never <p>z", "a b\nc"),
    "references": ("<p>1 < 2 &amp; 3 > 2 &lt;b&gt;&nbsp;x &copy &#x41;&#66;</p>", "1 < 2 & 3 > 2 <b> x © AB"),
    "attributes": ("<p title=\"a>b\" class='c>d'>ok</p><p title=it's>fine</p>", "ok\nfine"),
    "cells": ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    "hidden": ('<div style="display: none">x<div>y</div></div><p hidden>q</p><select><option>r</select><p>z', "z"),
    "notices": ('<div class="cookieBar">we</div><div role="alert">now</div><div id="newsletter-2">join</div><p>t</p>', "t"),
    "deep": ("<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>after", "deep\nafter"),
    "white space": ("<p> a\n\t b<i>c</i> </p>\n\n<p></p> d ", "a bc\nd"),
    "outside an article": ("<h2>site</h2><article><p>x</p></article><div>other</div>", "x"),
}


@pytest.mark.parametrize("name", CASES)
def test_page(name):
    page, text = CASES[name]
    assert site_tree.main_text(page) == text


def article_text(page):
    """The text of a page of the test tables, whose article has no other markup than this."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = [" ".join(markup.unescape(re.sub("</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", inner)]
    return "\n".join(p for p in parts if p)


def test_pages_query(spark, sf):
    got = {r["page_id"]: r for r in queries.queries()["op13_site_style_tree"](spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        assert got[p["page_id"]]["text"] == article_text(p["html"]) and got[p["page_id"]]["n_chars"] == len(article_text(p["html"])) and got[p["page_id"]]["url"] == p["url"]


def unnamed(i, articles=True):
    """A page whose template has no telling names: menus, a slogan, a line within the article."""
    rnd = random.Random(i)
    words = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    menu = f"<div class=q1><ul><li><a href=/>home</a><li><a href=/n>news {i % 3}</a></ul></div>"
    body = f"<h1>{words(3)}</h1><p>{words(40)}</p><p>{words(30)}</p><div class=q3>Read on at our site {i % 2}</div>"
    tag = "article" if articles else "div class=q2"
    return f"<html><body>{menu}<{tag}>{body}</{tag.split()[0]}><div class=q4>slogan of the day {i % 5}</div></body></html>"


@pytest.mark.parametrize("articles", [True, False])
def test_entropy_finds_templates(spark, articles):
    """Without a name that tells, branches go by entropy alone; on a host of few pages they stay."""
    rows = [(i, f"http://big.example/{i}", unnamed(i, articles)) for i in range(300)] + [(1000 + i, f"http://small.example/{i}", unnamed(i, articles)) for i in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    got = {r["page_id"]: r["text"] for r in site_tree.extracted(df).collect()}
    for i in range(300):
        assert got[i].count("\n") == 2 and "Read on" not in got[i] and "home" not in got[i] and "slogan" not in got[i]
    assert all("Read on" in got[1000 + i] and ("home" in got[1000 + i]) != articles for i in range(3))
    tree = {r["names"]: r for r in site_tree.style_tree(df).where("host = 'big.example'").collect()}
    menu = tree["html/body/div/ul/li"]
    assert menu["pages"] == 300 and menu["content"] < 0.4 and tree["html/body"]["importance"] > 0.5


def test_copies_are_no_template(spark):
    """A host whose articles are mostly copies of one, exact and near, keeps them whole."""
    rnd = random.Random(2)
    words = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    copied = [words(30) for _ in range(6)]
    texts = [("T", *copied)] * 200 + [("T", *copied[:-1], words(30)) for _ in range(200)] + [(words(2), words(30), words(9)) for _ in range(200)]
    page = lambda t, i: f"<nav><a>m{i}</a></nav><article><h1>{t[0]}</h1>{''.join(f'<p>{p}' for p in t[1:])}</article>"
    df = spark.createDataFrame([(i, "http://h.example/", page(t, i)) for i, t in enumerate(texts)], "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in site_tree.extracted(df).collect()} == {i: "\n".join(t) for i, t in enumerate(texts)}


def test_odd_pages(spark):
    long = "<p>" + "word " * 400_000
    rows = [(1, None, None), (2, "http://a.example", ""), (2, "http://a.example", ""), (None, "nonsense", "<p>x"), (3, None, "<p>y"), (4, "http://a.example", long), (5, "http://a.example", "plain & text"), (5, "http://a.example", "plain & text")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("host", "node", "rules", "text", "path")})
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in site_tree.extracted(df).collect()]
    want = [(1, "", 0), (2, "", 0), (2, "", 0), (None, "x", 1), (3, "y", 1), (4, long[3:].strip(), len(long) - 4), (5, "plain & text", 12), (5, "plain & text", 12)]
    assert sorted(got, key=str) == sorted(want, key=str)
    empty = site_tree.extracted(df.limit(0))
    assert empty.count() == 0 and empty.columns == ["page_id", "url", "text", "n_chars"]
    with pytest.raises(ValueError, match="named like results"):
        site_tree.extracted(df, keep=("page_id", "text"))
