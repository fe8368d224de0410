import hashlib
import random
from collections import Counter

from folioscope.llm import suffix_dedup as S


def plain(texts, n):
    seen = Counter(t[i : i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - n + 1):
            if seen[t[i : i + n]] > 1:
                gone[i : i + n] = [True] * n
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), runs, bytes(c for c, g in zip(t, gone, strict=True) if not g)))
    return out


def test_against_brute_force(spark):
    rng = random.Random(2)
    for alphabet, n, a in ((b"ab", 9, 4), (b"abcd", 12, 5), (bytes(range(97, 123)), 8, 3), (b"a", 6, 2)):
        base = [bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(6)]
        texts = []
        for _ in range(40):
            t = b""
            for _ in range(rng.randint(0, 3)):
                b = rng.choice(base)
                i = rng.randint(0, len(b))
                t += b[i : rng.randint(i, len(b))] if rng.random() < 0.8 else bytes(rng.choice(alphabet) for _ in range(7))
            texts.append(t)
        rows = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts)], "doc_id long, text string")
        for most in (S.MOST, 2):
            got = [(r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in S.remaining(rows, length=n, anchor=a, most=most).orderBy("doc_id").collect()]
            assert got == plain(texts, n)


def test_long_repeats_and_odd_rows(spark):
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh é") for _ in range(450))
    own = ["".join(rng.choice("ijklmnop") for _ in range(700)) for _ in range(4)]
    docs = [(1, own[0] + passage + own[1]), (2, own[2] + passage), (3, own[3]), (4, None), (5, ""), (6, "x" * 3000), (3, own[3]), (None, passage[:399])]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["doc_id"], r["n_removed"]): r for r in S.digests(rows).collect()}
    want = {(d[0], w[1]): w for d, w in zip(docs, plain([(t or "").encode() for _, t in docs], 400), strict=True)}
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert (got[k]["n_bytes"], got[k]["n_spans"], got[k]["kept_sha256"]) == (w[0], w[2], hashlib.sha256(w[3]).hexdigest())
    assert S.digests(rows.limit(0)).count() == 0


def test_texts_over_a_chunk(spark):
    size = S.CHUNK + 5000
    rng = random.Random(6)
    body = bytes(rng.choice(b"abcdefghijklmnop") for _ in range(size)).decode()
    rows = spark.createDataFrame([(1, body), (2, body[S.CHUNK - 300 : S.CHUNK + 300])], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in S.digests(rows).collect()}
    assert got == {1: (600, 1), 2: (600, 1)}
