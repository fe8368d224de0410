"""Language, personal data, decontamination and the pipeline."""

import random
import re
import time
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from folioscope.llm import decontaminate, language_id, pii


def test_language_accuracy_on_held_out_rows(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('sf0.001', 'sf0.01')}/documents.parquet")
    model = language_id.train(docs)
    rows = [r for r in language_id.predict(docs, model).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(rows) > 150 and sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.98
    assert sum(r["rejected"] for r in rows) / len(rows) < 0.01
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_an_unlearned_language_is_rejected(spark, sf):
    """Calibrated on what it learned, the model knows what it did not learn by little evidence."""
    docs = spark.read.parquet(f"{sf.replace('sf0.001', 'sf0.1')}/documents.parquet").select("doc_id", "text", "lang").cache()
    for unknown in ("en", "de"):
        model = language_id.train(docs.where(F.col("lang") != unknown))
        assert unknown not in model.languages
        out = language_id.scored(docs, model).where(F.length("text") > 300).groupBy(F.col("lang") == unknown, "__language.rejected").count().collect()
        n = {(r[0], r[1]): r[2] for r in out}
        assert n[True, True] > 0.9 * (n[True, True] + n.get((True, False), 0)), n
        assert n.get((False, True), 0) < 0.015 * n[False, False], n


def test_user_columns_stay(spark, sf):
    """Columns named like results come through the stages as they are."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumns({"score": F.lit(7.0), "rejected": F.lit("x"), "lang_pred": F.lit(1), "hits": F.lit("mine"), "spans": F.lit(2), "ids": F.lit(3), "__language": F.lit(None).cast("string")})
    clash = docs.drop("__language")
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    for out in (language_id.accepted(clash, language_id.train(docs)), decontaminate.clean(clash, bench), pii.mask(clash, pii.fit(clash))):
        assert out.columns == clash.columns and out.count() > 0
        assert out.where("score = 7.0 and rejected = 'x' and lang_pred = 1 and hits = 'mine' and spans = 2 and ids = 3").count() == out.count()


def test_language_of_odd_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.train(docs)
    odd = spark.createDataFrame([(1, None, "en"), (2, "", None), (3, "12 34 --", "en"), (4, "the and", None), (4, "the and", None)], "doc_id long, text string, lang_pred string")
    got = language_id.predict(odd, model)
    assert got.columns == ["doc_id", "text", "lang_pred", "score", "rejected"]
    rows = got.collect()
    assert [(r["lang_pred"], r["score"], r["rejected"]) for r in rows[:3]] == [("und", 0.0, True)] * 3
    assert rows[3] == rows[4] and rows[3]["lang_pred"] in model.languages and rows[3]["score"] > 0.25
    nothing = language_id.train(docs.limit(0))
    assert {r["lang_pred"] for r in language_id.predict(odd, nothing).collect()} == {"und"}
    assert language_id.predict(odd.limit(0), model).count() == 0


def test_scores_of_a_text_do_not_depend_on_its_neighbours(spark):
    texts = [b"", b"abc def", b"  x ", "Ünï code".encode(), b"a", b"last one!"]
    rng = np.random.default_rng(0)
    model = language_id.Model(["a", "b"], rng.normal(size=(language_id.BUCKETS, 2)).astype(np.float32), np.zeros(2))
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    together = model.probabilities(b"".join(texts), off)
    for t, p in zip(texts, together, strict=True):
        if t:
            assert np.allclose(model.probabilities(t, np.array([0, len(t)])), p, atol=1e-12)


SAMPLES = [
    "mail bob.x+1@host.example.com, or a@b.c.d now",
    "ip 10.0.0.1 and 300.1.1.1 v1.2.3.4.5",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112",
    "phone +1 (555) 123-4567 or call (555) 123-4567, é +1 2",
    "ssn 123-45-6789",
    "",
    None,
]


PLAIN = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s, d: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s, d: all(int(p) <= 255 for p in s.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda s, d: 16 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d))) % 10 == 0),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s, d: 8 <= len(d) <= 15),
}


def plain_spans(t):
    return [(k, m.start(), m.end()) for k, (p, ok) in PLAIN.items() for m in re.finditer(p, t) if ok(m[0], re.sub("[^0-9]", "", m[0]))]


def test_base_spans():
    """Scans that start at signs find what the fixed patterns find, leftmost and not overlapping."""
    text = SAMPLES[0]
    assert [text[a:b] for _, a, b in pii.base_spans(text)] == ["bob.x+1@host.example.com", "a@b.c.d"]
    rng = random.Random(6)
    signs = ["a", "B", "1", "25", "255", "256", "007", ".", ".", "@", "@", "-", "+", " ", "(", "%", "é", "\n", "4111 1111 1111 1111", "+1 555", "x@y.z", "1.2.3.4"]
    for t in [*(x or "" for x in SAMPLES), *("".join(rng.choice(signs) for _ in range(rng.randint(0, 25))) for _ in range(20_000))]:
        assert sorted(pii.base_spans(t)) == sorted(plain_spans(t)), t
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_personal_data_of_very_long_texts():
    """A megabyte of one word, of digits, or of thousands of candidates takes seconds at most."""
    for t, n in (("a" * 10**6 + "@", 0), ("1" * 10**6, 0), ("1." * 5 * 10**5, 10**6 // 8), ("a@b.cd " * 10**5, 10**5), ("a.-" * 300_000 + " at x dot com", 0), ("555-123-4567 " * 50_000, 0), ("+1" * 400_000, 0)):
        began = time.perf_counter()
        base, more = pii.candidates(t)
        assert abs(len(base) - n) <= 1 and time.perf_counter() - began < 10
        assert t[0] != "5" or len(more) == 50_000


def planted(rng):
    """(text, is the looser span in it personal data) with look-alikes that speak against themselves."""
    d = lambda n: "".join(rng.choice("23456789") for _ in range(n))
    first, last = rng.choice(sorted(pii.FIRST_NAMES)), rng.choice(["Miller", "Garcia", "Weber", "Novak", "Rossi", "Petit", "Baker"])
    year, day = rng.randint(1930, 2005), f"{rng.randint(1, 12):02}-{rng.randint(10, 28)}"
    yes = [
        f"call me at {d(3)}-{d(3)}-{d(4)} anytime", f"phone: ({d(3)}) {d(3)}-{d(4)}", f"her ssn is {rng.randint(1, 6)}{d(2)}-{d(2)}-{d(4)}",
        f"signed, {first} {last}", f"my name is {first} {last}", f"was met by Mr {first} {last} who called", f"born {year}-{day}", f"dob {year}-{day}",
        f"write to {first.lower()} at {last.lower()} dot com", f"contact {first.lower()}[at]{last.lower()}[dot]org", f"she lives at {d(3)} {last} Street",
    ]
    no = [
        f"order {d(3)}-{d(3)}-{d(4)} units", f"serial {d(3)}-{d(2)}-{d(4)}", f"part no. 9{d(2)}-{d(2)}-{d(4)}", f"the brand {first} {last} museum",
        f"published {rng.randint(2021, 2030)}-{day}", f"release {rng.randint(2021, 2030)}-{day}", "we sat at home dot matrix", f"invoice 1{d(2)}-1{d(2)}-{d(4)} pieces",
    ]
    return [(t, 1) for t in yes] + [(t, 0) for t in no]


def test_weak_supervision_decides(spark):
    """Looser spans are told from look-alikes that the patterns take for the same, without any
    label; accepting all or none of them gives another result."""
    rng = random.Random(21)
    rows = [(i, f"Well, {t} and so on.", y) for i, (t, y) in enumerate(x for _ in range(40) for x in planted(rng))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, truth int")
    model = pii.fit(docs)
    got = {r["doc_id"]: r for r in pii.find(docs, model).collect()}
    held = [i for i, t, y in rows if got[i]["base_spans"] == ""]
    found = {i for i in held if got[i]["n_spans"]}
    truth = {i for i in held if rows[i][2]}
    assert len(found & truth) / len(found) > 0.95 and len(found & truth) / len(truth) > 0.9
    loose = {r["doc_id"] for r in pii.find(docs, model, accept=0.0).where("n_spans > 0").collect()} & set(held)
    assert len(loose & truth) / len(loose) < 0.8 and pii.find(docs, model, accept=2.0).where("n_spans > 0").count() < len(rows) // 10
    # a version number that looks like an address stays, as base spans do, but is doubted
    odd = spark.createDataFrame([(i, f"version 0.{i}.3.4 of the part") for i in range(1, 60)] + [(i, f"the server at ip 10.{i}.3.4 is up") for i in range(60, 200)], "doc_id long, text string")
    rated = pii.find(odd, pii.fit(odd)).collect()
    assert all(r["n_ip"] == 1 and r["n_spans"] == 1 for r in rated)
    assert {r["doc_id"] < 60 for r in rated if r["doubted"]} == {True} and sum(r["doubted"] != "" for r in rated) > 50


def test_expectation_maximisation_finds_reliable_labelers():
    rng = random.Random(1)
    counts: dict = {}
    for _ in range(5000):
        y = rng.random() < 0.4
        vote = tuple((1 if (rng.random() < acc) == y else -1) for acc in (0.95, 0.8, 0.65))
        counts[vote] = counts.get(vote, 0) + 1
    rows = sorted(counts.items())
    prior, reliable, found = pii.expectation_maximisation(rows)
    post = {v: p for (v, _), p in zip(rows, found, strict=True)}
    assert abs(prior[""] - 0.4) < 0.06
    means = [sum(r) / 2 for r in reliable[""]]
    assert means[0] > means[1] > means[2] and abs(means[0] - 0.95) < 0.05
    assert post[(1, 1, 1)] > 0.9 > 0.1 > post[(-1, -1, -1)]


def test_personal_data(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = docs.unionByName(spark.createDataFrame([(-i - 1, t) for i, t in enumerate([*SAMPLES, SAMPLES[0]])], "doc_id long, text string")).withColumn("spans", F.lit("x"))
    model = pii.fit(rows)
    got = {r["doc_id"]: r for r in pii.find(rows, model).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in rows.collect()}
    for i, r in got.items():
        base = plain_spans(texts[i])
        assert r["base_spans"] == pii.joined(base) and [r[f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in base) for k in pii.BASE]
        assert set(r["base_spans"].split(",")) - {""} <= set(r["spans"].split(","))
    assert pii.find(rows.limit(0), model).count() == 0 and pii.fit(rows.limit(0)).prior == {}
    hidden = {r["doc_id"]: r["text"] for r in pii.mask(rows, model).collect()}
    assert hidden[-1] == "mail <EMAIL>, or <EMAIL> now" and hidden[-7] is None
    assert all(hidden[i] == t for i, t in texts.items() if not got[i]["spans"] and i != -7)


def benchmark(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(12, 60)))) for i in range(30)]
    return items, words, rng


def plain_hits(text, items):
    """Items with a window of their size that is 0.8 similar, by definition: words of letters,
    digits and signs beyond ASCII, five-word shingles as tuples, multisets."""

    def shingles(t):
        w = re.findall(r"[a-z0-9\x80-\U0010ffff]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))
        return [tuple(w[i : i + 5]) for i in range(len(w) - 4)], len(w)

    def similarity(a, b):
        a, b = Counter(a), Counter(b)
        return sum((a & b).values()) / sum((a | b).values())

    h, n = shingles(text)
    out = set()
    for i, t in items:
        q, m = shingles(t or "")
        if q and h and max(similarity(h[s : s + len(q)], q) for s in range(max(1, n - m + 1))) >= 0.8:
            out.add(i)
    return out


def test_contamination_against_brute_force(spark):
    items, words, rng = benchmark(spark)
    docs = []
    for i in range(60):
        body = [rng.choice(words) for _ in range(rng.randint(0, 120))]
        for _ in range(i % 3):
            passage = rng.choice(items)[1].split()
            for _ in range(rng.randint(0, 2)):
                passage[rng.randrange(len(passage))] = rng.choice(words)
            at = rng.randint(0, len(body))
            body[at:at] = passage[: rng.choice([len(passage), len(passage) - 1, len(passage) // 2])]
        docs.append((i, " ".join(body).upper().replace(" ", ",  ") if i % 5 == 0 else " ".join(body)))
    docs += [(100, None), (101, ""), (102, items[0][1]), (102, items[0][1]), (103, "one two")]
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame([*items, (90, "too short here"), (91, None), (0, items[0][1])], "item_id long, text string")
    got = decontaminate.contamination(rows, bench).collect()
    assert len(got) == len(docs)
    for r in got:
        assert {h["item_id"] for h in r["hits"]} == plain_hits(r["text"] or "", items), r["doc_id"]
    assert decontaminate.weight(items[0][1]) * 2 > 5000
    blocks = decontaminate.contamination(rows, bench, block_bytes=5000).collect()
    assert [{h["item_id"] for h in r["hits"]} for r in blocks] == [{h["item_id"] for h in r["hits"]} for r in got]
    kept = decontaminate.clean(rows, bench)
    assert kept.columns == rows.columns and kept.count() == sum(not r["hits"] for r in got)
    assert decontaminate.contamination(rows.limit(0), bench).count() == 0
    assert decontaminate.clean(rows, bench.limit(0)).count() == len(docs)


def test_every_print_within_the_radius_is_looked_up():
    rng = np.random.default_rng(3)
    items = [(0, "a b c d e f g h i j k l")]
    index = decontaminate.indexed(items)
    (n,) = index.prints
    target = int(index.prints[n][0])
    for _ in range(500):
        flips = rng.choice(64, int(rng.integers(0, decontaminate.RADIUS + 1)), replace=False)
        near = np.array([target ^ sum(1 << int(f) for f in flips)], np.uint64).view(np.uint8)
        assert any(index.tables[n][b][near[b]][0] for b in range(8))


def plain_masked(t):
    """t with its base spans replaced, overlaps going to the first and longest."""
    out, at = "", 0
    for a, b, k in sorted(((a, b, k) for k, a, b in plain_spans(t)), key=lambda s: (s[0], -s[1])):
        if a >= at:
            out += t[at:a] + f"<{k.upper()}>"
        at = max(at, b)
    return out + t[at:]


def test_pipeline_like_brute_force(spark, sf):
    """Rows of run() against the definition of each stage but the first, whose model is trained:
    all pairs by Jaccard, all windows of items, fixed patterns, and the tokenizer library."""
    import base64

    import public_tokenizers
    import tiktoken

    docs = [(r["doc_id"], r["text"]) for r in corpus_pipeline.language(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf).select("doc_id", "text").orderBy("doc_id").collect()]
    shingles = {}
    for i, t in docs:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode().split()
        shingles[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    root = {i: i for i, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, _) in enumerate(docs):
        for j, _ in docs[n + 1 :]:
            a, b = shingles[i], shingles[j]
            if len(a & b) >= 0.8 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    fold = lambda t: set(zip(*(re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower())[k:] for k in range(5)), strict=False))
    known = [(i, t, fold(t)) for i, t in items]
    path = public_tokenizers.path(corpus_pipeline.VOCABULARY)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for i, t in docs:
        own = fold(t or "")
        # items without a shingle in common have similarity 0
        if find(i) == i and not plain_hits(t or "", [(k, x) for k, x, f in known if own & f]):
            want[i] = np.array(library.encode_ordinary(plain_masked(t or "")), "<u4").tobytes()
    got = {r["doc_id"]: bytes(r["ids"]) for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == want and 0 < len(want) < len(docs)


def test_pipeline(spark, sf):
    """Each stage keeps what the ones before it kept and what its own rule allows."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, seen, sf).cache()
        if name != "byte_bpe":
            assert out.columns == docs.columns
        assert {r["doc_id"] for r in out.select("doc_id").collect()} <= {r["doc_id"] for r in seen.select("doc_id").collect()}
        seen = out
    whole = corpus_pipeline.run(spark, sf)
    assert sorted(r["doc_id"] for r in whole.collect()) == sorted(r["doc_id"] for r in seen.collect())
    assert whole.where("not exact").count() == 0 and 0 < whole.count() < docs.count()
