import random

import xxhash
from pyspark.sql import functions as F

from folioscope.llm import graph
from folioscope.llm import simhash_dedup as S
from folioscope.llm.graph import components

WORDS = [f"w{i}" for i in range(300)]


def plain_print(t, n=4):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t).encode().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + n]), 42) for i in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reach(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def texts():
    rng = random.Random(3)
    out = []
    for _ in range(25):
        base = [rng.choice(WORDS) for _ in range(rng.randint(0, 200))]
        for _ in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                if copy:
                    copy[rng.randrange(len(copy))] = rng.choice(WORDS).upper()
            out.append(" ".join(copy))
    return [*out, "", None, " \n", "one", "One two"]


def test_prints_and_components(spark):
    docs = [(i, t, 0) for i, t in enumerate(texts())]
    docs.append(docs[3])
    rows = spark.createDataFrame(docs, "doc_id long, text string, fp int")
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in S.near_duplicates(rows).collect()}
    prints = {i: plain_print(t or "") for i, t, _ in docs}
    assert {i: p for i, (p, _) in got.items()} == prints
    ids = sorted(prints)
    want = reach(ids, [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 4])
    assert {i: c for i, (_, c) in got.items()} == want
    assert S.near_duplicates(rows).count() == len(docs)
    assert S.near_duplicates(rows.limit(0)).count() == 0


def test_large_cells(spark):
    """A dense group, far beyond the size of a cell's block, loses no link."""
    rng = random.Random(5)
    center = rng.getrandbits(64)
    fps = {center} | {center ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(400)} | {rng.getrandbits(64) for _ in range(100)}
    signed = [x - (1 << 64) if x >= 1 << 63 else x for x in fps]
    table = spark.createDataFrame([(x, x) for x in signed], "node long, fp long")
    found = components(S.links(table, cell=16)).collect()
    want = reach(signed, [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4])
    want = {n: r for n, r in want.items() if list(want.values()).count(r) > 1}
    assert {r["node"]: r["root"] for r in found} == want


def test_cells_of_several_components(spark):
    """Groups that share cells without a link, one that a chain ties to another, and loners: as all pairs have it."""
    rng = random.Random(8)
    flips = lambda n: sum({1 << rng.randrange(64) for _ in range(n)})
    center = rng.getrandbits(64)
    far, tied = center ^ (1 << 20) - 1, center ^ ((1 << 16) - 1 << 40)
    fps = {c ^ flips(3) for c, n in ((center, 300), (far, 90), (tied, 60)) for _ in range(n)}
    fps |= {tied ^ ((1 << k) - 1 << 40) for k in range(0, 17, 4)} | {center ^ flips(3) ^ rng.getrandbits(20) for _ in range(80)}
    signed = [x - (1 << 64) if x >= 1 << 63 else x for x in fps]
    table = spark.createDataFrame([(x, x) for x in signed], "node long, fp long")
    got = {r["node"]: r["root"] for r in components(S.links(table, cell=24)).collect()}
    want = reach(signed, [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4])
    assert {n: got.get(n, n) for n in signed} == want and 2 < len(set(want.values()))


def test_meetings_of_near_copies_grow_in_proportion(spark):
    """20,000 near copies: each cell's rows meet three times at most, and not again once they are one component."""
    rng = random.Random(6)
    center = rng.getrandbits(63)
    fps = list({center ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for _ in range(26000)})[:20000]
    table = spark.createDataFrame([(x, x) for x in fps], "node long, fp long")
    rows = S.cells(table, 6).cache()
    n, first = rows.count(), S.first_meetings(rows, 256)
    assert n > 10 * len(fps) and first.count() <= 3.2 * n
    assert first.groupBy("i", "key", "p", "q").count().agg(F.max("count")).first()[0] < 2 * 256 * 1.5
    one = table.select("node", F.lit(fps[0]).alias("root"))
    assert S.other_meetings(rows, one, 256).count() == 0
    # with 100 of them not yet linked, only these go to every block
    most = table.select("node", F.when(F.col("node").isin(fps[:100]), F.col("node")).otherwise(fps[-1]).alias("root"))
    assert S.other_meetings(rows, most, 256).count() <= 2 * n
    rows.unpersist()


def test_blocks_grow_with_the_input():
    assert [S.blocks_for(n) for n in (10, 1 << 25, 1 << 28, 1 << 34, 1 << 60)] == [6, 6, 7, 8, 10]


def test_chain(spark):
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["root"] for r in components(links).collect()} == {0}
    assert components(links.limit(0)).count() == 0


def test_one_of_each_group(spark):
    rng = random.Random(9)
    docs, group = [], {}
    for g in range(30):
        base = [rng.choice(WORDS) for _ in range(300)]
        for c in range(rng.randint(1, 6)):
            copy = list(base)
            if c % 3 == 2:
                copy[rng.randrange(300)] = "changed"
            group[len(docs)] = g
            docs.append((len(docs), " ".join(copy), 1))
    n = len(docs)
    # half the words of the first text: no near-duplicate
    docs += [(n, " ".join(docs[0][1].split()[:150] + [rng.choice(WORDS) for _ in range(150)]), 1), docs[0], (None, docs[0][1], 1), (n + 1, None, 1), (n + 2, "", 1), (n + 2, "", 1)]
    rows = spark.createDataFrame(docs, "doc_id long, text string, fp int")
    out = S.one_of_each(rows)
    kept = sorted(r["doc_id"] for r in out.collect())
    assert out.columns == rows.columns
    assert kept == sorted([min(i for i, x in group.items() if x == g) for g in range(30)] + [n, n + 1])
    assert S.one_of_each(rows.limit(0)).count() == 0


def changed_words(rng, base, n):
    """The words of a text, n of them, far apart, replaced by new ones."""
    out = list(base)
    for i in range(n):
        out[3 + i * (len(base) // n)] = f"x{rng.getrandbits(40)}"
    return out


def similarity(a, b):
    a, b = ({tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (a, b))
    return len(a & b) / len(a | b)


def test_pairs_near_the_threshold(spark):
    """Of pairs between 0.8 and 0.9 every one is found, of pairs just below 0.8 none."""
    rng = random.Random(31)
    docs, near = [], 0
    for g in range(120):
        base = [f"v{rng.getrandbits(40)}" for _ in range(400)]
        other = changed_words(rng, base, (8, 6, 10)[g % 3])
        near += similarity(base, other) >= 0.8
        docs += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(other))]
    assert near == 80
    assert S.one_of_each(spark.createDataFrame(docs, "doc_id long, text string")).count() == len(docs) - near


def test_every_pair_of_a_group_is_verified(spark):
    """Texts that share a template are unlike each other; the near pairs among them are
    found nonetheless, in one block or in several."""
    rng = random.Random(32)
    template = [f"v{rng.getrandbits(40)}" for _ in range(600)]
    docs = []
    for _ in range(150):
        tail = [f"v{rng.getrandbits(40)}" for _ in range(100)]
        docs.append(template + tail)
    twins = [changed_words(rng, d, 6) for d in docs[:60]]
    assert similarity(docs[0], docs[1]) < 0.8 < 0.85 < similarity(docs[0], twins[0])
    rng.shuffle(docs)
    rows = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs + twins)], "doc_id long, text string")
    for cell in (512, 40):
        assert sorted(r["doc_id"] for r in S.one_of_each(rows, cell=cell).collect()) == list(range(150))


def test_one_repeated_line_makes_no_copies(spark):
    rng = random.Random(33)
    line = " ".join(rng.choice(WORDS) for _ in range(9))
    docs = [(i, "\n".join([line] * 100 + [" ".join(f"v{rng.getrandbits(40)}" for _ in range(300))])) for i in range(6)]
    assert len({S.fingerprint(t.encode(), 5) for _, t in docs}) < 6
    assert S.one_of_each(spark.createDataFrame(docs, "doc_id long, text string")).count() == 6


def test_fingerprints_link_texts_of_the_pipeline(spark):
    """Without any band the pivot tables alone find what lies within the radius; sets decide, each shingle counted once."""
    rng = random.Random(34)
    docs = []
    for _ in range(40):
        base = [f"v{rng.getrandbits(40)}" for _ in range(400)]
        docs += [base, changed_words(rng, base, 1), changed_words(rng, base, 2)]
    prints = [S.simhash(S.np.unique(S.shingle_hashes(" ".join(d).encode(), 5))) for d in docs]
    want = reach(range(len(docs)), [(a, b) for b in range(len(docs)) for a in range(b) if (prints[a] ^ prints[b]).bit_count() <= 4])
    line = " ".join(rng.choice(WORDS) for _ in range(9))
    odd = ["\n".join([line] * 100 + [" ".join(f"v{rng.getrandbits(40)}" for _ in range(300))]) for _ in range(4)]
    rows = spark.createDataFrame([*enumerate(" ".join(d) for d in docs), *enumerate(odd, len(docs))], "doc_id long, text string")
    kept = [r["doc_id"] for r in S.one_of_each(rows, bands=0).collect()]
    assert sorted(kept) == sorted({*want.values(), *range(len(docs), len(docs) + 4)}) and len(set(want.values())) < 60
    assert S.one_of_each(rows, bands=0, similarity=0.999).count() == rows.count()


def test_contracted_links(spark):
    rng = random.Random(5)
    name = {i: xxhash.xxh3_128_digest(str(i).encode()) for i in range(400)}
    pairs = [(name[a], name[b]) for a, b in (rng.sample(range(400), 2) for _ in range(300))]
    want = reach({x for p in pairs for x in p}, pairs)
    links = spark.createDataFrame([*pairs, *pairs[:20], (None, name[0]), (name[0], name[0])], "a binary, b binary").repartition(3)
    assert {bytes(r["node"]): bytes(r["root"]) for r in components(links, contract=True).collect()} == want
    u, v = (F.col(c).alias(n) for c, n in (("a", "u"), ("b", "v")))
    some = graph.contracted(links.dropna().where("a <> b").select(u, v), chunk=7).collect()
    assert all(r["v"] < r["u"] for r in some) and reach(set(want), [(bytes(r["u"]), bytes(r["v"])) for r in some]) == want
    chain = spark.createDataFrame([(k, k + 1) for k in range(-50, 50)], "a bigint, b bigint")
    assert {(r["node"], r["root"]) for r in components(chain, contract=True).collect()} == {(k, -50) for k in range(-50, 51)}
    assert components(links.limit(0), contract=True).count() == 0


def test_few_links_take_one_round(spark, monkeypatch):
    """Each round is a plan that the driver holds: few links in one task settle in one."""
    made, real = [], graph.written
    monkeypatch.setattr(graph, "written", lambda df: made.append(df) or real(df))
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id int, text string")
    S.one_of_each(docs).count()
    assert len(made) == 3 * 2
