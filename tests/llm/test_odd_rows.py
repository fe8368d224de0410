"""Odd rows through every operator and every stage of the pipeline: null, empty, blank and very long
texts, ties, repeated rows, columns with clashing names, and empty tables."""

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from folioscope.llm import bpe, decontaminate, language_id, license_scan, pii, quality_rules, secrets, simhash_dedup, suffix_dedup, url_lists

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PROSE = "The river ran past the old mill and the people walked over the bridge to sell bread. "
LONG = {"words": PROSE * 12_000, "one word": "a" * 1_000_000, "one line": "b c\n" * 250_000, "letters": "é日" * 150_000}
CLASHES = ("score", "rejected", "lang_pred", "hits", "spans", "ids", "decoded", "n_bytes", "kept", "fp", "node", "bands", "r1", "r2", "key", "root", "n", "words", "base", "stratum", "paragraphs", "n_words", "size", "__r1", "__language", "__hits", "z", "t")


@pytest.fixture(scope="module")
def rows(spark):
    texts = [None, "", " \n\t", "One.", PROSE, PROSE, PROSE.upper(), "12 34", "\x00\x1f￾", *LONG.values()]
    data = [(i, t, "en" if i % 2 else None, "src", 1) for i, t in enumerate(texts)]
    data += [data[0], data[4], data[4], (None, PROSE, "en", None, None), (None, None, None, None, None), (4, "another text of a repeated id", "de", "src", 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars int")
    return docs.withColumns({c: F.lit(f"mine {c}") for c in CLASHES}).cache()


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(0, PROSE), (0, PROSE), (1, None), (2, ""), (3, "too short")], "item_id long, text string").withColumn("score", F.lit(1))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (4, 0, 0), (None, 1, 1), (99, None, None)], "doc_id long, quality int, toxic int")


def known(spark):
    """A model of languages learned from a few rows."""
    data = [(i, f"{w} " * 30, k) for i in range(40) for k, w in (("en", f"the house{i} and"), ("de", f"das haus{i} und"))]
    return language_id.train(spark.createDataFrame(data, "doc_id long, text string, lang string"))


def applied(name, spark, docs, bench, labels):
    """The operator's result, one row for each row of docs."""
    match name:
        case "simhash":
            return simhash_dedup.near_duplicates(docs)
        case "suffix":
            return suffix_dedup.digests(docs)
        case "licence":
            return license_scan.scan(docs, license_scan.fitted([PROSE], rounds=2, steps=50))
        case "quality":
            return quality_rules.quality(docs, labels)
        case "personal":
            return pii.find(docs, pii.fit(docs))
        case "secret":
            return secrets.report(docs)
        case "contamination":
            return decontaminate.contamination(docs, bench)
        case "language":
            return language_id.predict(docs, known(spark))
        case "bpe":
            return bpe.digests(docs, PATH)


OPERATORS = ("simhash", "suffix", "licence", "quality", "personal", "secret", "contamination", "language", "bpe")


@pytest.mark.parametrize("name", OPERATORS)
def test_operator(name, spark, rows, bench, labels):
    out = applied(name, spark, rows, bench, labels)
    got = [r.asDict(recursive=True) for r in out.collect()]
    assert len(got) == rows.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append({k: str(v) for k, v in r.items()})
    # repeated rows agree, and a further text of their id is told by itself
    assert by_id[0][0] == by_id[0][1] and len({tuple(sorted(x.items())) for x in by_id[4]}) <= 2
    empty = applied(name, spark, rows.limit(0), bench, labels)
    assert empty.count() == 0 and empty.columns == out.columns
    nothing = applied(name, spark, rows.where("text is null"), bench.limit(0), labels.limit(0))
    assert nothing.count() == rows.where("text is null").count()


def test_defined_results(spark, rows, bench, labels):
    """What odd rows come to, as the docstrings say."""
    first = lambda name: {r["doc_id"]: r for r in applied(name, spark, rows, bench, labels).where("doc_id in (0, 1, 2, 5, 7, 8)").collect()}
    nothing = (0, 1, 2)
    assert {first("simhash")[i]["fingerprint"] for i in nothing} == {"0" * 16} and {first("simhash")[i]["component_id"] for i in nothing} == {0}
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"]) for i, r in sorted(first("suffix").items()) if i in nothing] == [(0, 0, 0), (0, 0, 0), (3, 0, 0)]
    assert all(first("licence")[i]["paragraphs"] == [] for i in nothing)
    assert all(r["base_failed"] and not r["kept"] and r["n_words"] == 0 for i, r in first("quality").items() if i in nothing)
    assert all(first("personal")[i]["spans"] == "" == first("secret")[i]["spans"] for i in nothing)
    assert all(first("contamination")[i]["hits"] == [] for i in nothing) and [h["item_id"] for h in first("contamination")[5]["hits"]] == [0]
    assert all((r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True) for i, r in first("language").items() if i in (*nothing, 7))
    assert [first("bpe")[i]["n_tokens"] for i in (0, 1)] == [0, 0]


def test_lists_of_odd_rows(spark):
    entries = "list string, effect string, scope string, key string, action string, at timestamp"
    pages = spark.createDataFrame([(1, None), (2, ""), (2, ""), (3, "http://a.b/" + "x" * 1_000_000), (None, "nonsense"), (4, "http://" + "a." * 300 + "b")], "page_id long, url string")
    pages = pages.withColumn("fetched_at", F.when(F.col("page_id") != 2, F.lit("2024-01-01").cast("timestamp"))).withColumns({c: F.lit(1) for c in ("key", "scope", "list", "verdict", "host", "since")})
    for listed in ([], [("l", "block", "host", "a.b", "add", None), ("l", None, "host", None, "add", None), (None, None, None, None, None, None)]):
        found = url_lists.evaluated(pages, spark.createDataFrame(listed, entries))
        assert found.count() == 6 and url_lists.evaluated(pages.limit(0), spark.createDataFrame(listed, entries)).count() == 0


def test_lists_of_far_times(spark):
    """A capture of the year 9999 makes one bucket more, not all up to it."""
    pages = spark.createDataFrame([(i, "http://a.b/", t) for i, t in enumerate(("2024-01-05", "2024-02-20", "9999-12-31", "0001-01-01", "1960-05-05"))], "page_id long, url string, t string").withColumn("fetched_at", F.col("t").cast("timestamp"))
    entries = spark.createDataFrame([("l", "block", "host", "a.b", "add", "1970-01-01"), ("m", "block", "domain", "b", "add", "2024-02-01"), ("m", "block", "domain", "b", "remove", "2024-03-01")], "list string, effect string, scope string, key string, action string, at string").withColumn("at", F.col("at").cast("timestamp"))
    found = url_lists.evaluated(pages, entries)
    assert {r["page_id"]: r["verdict"] for r in found.select("page_id", "verdict").collect()} == {0: "block", 1: "block", 2: "block", 3: "none", 4: "none"}
    held = sorted(r[0] for r in pages.select(url_lists.bucket_of(F.col("fetched_at"), 30)).collect())
    assert url_lists.laid(url_lists.intervals(entries), held).count() == 3 + 1


def test_sample_of_many_languages(spark):
    """However many languages `lang` names, the sample stays within its characters; each of the commonest has a part."""
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("w"), F.col("id").cast("string"), F.lit(" ")), 100).alias("text"), F.concat(F.lit("l"), (F.col("id") % 500).cast("string")).alias("lang"))
    texts, langs = language_id.training_sample(rows, in_all=100_000)
    assert 50_000 < sum(map(len, texts)) <= 150_000 and len(set(langs)) > 50
    assert len(set(language_id.training_sample(rows, languages=7)[1])) == 7
    long = spark.createDataFrame([(i, "x " * 30_000, f"l{i}") for i in range(40)], "doc_id long, text string, lang string")
    texts, langs = language_id.training_sample(long, in_all=80_000)
    assert len(langs) == len(set(langs)) >= 20 and sum(map(len, texts)) <= 80_000


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage(name, spark, sf, rows):
    """Stages keep columns as they are, take odd rows, and keep clean documents."""
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, rows, sf)
    n = out.count()
    if name == "byte_bpe":
        assert n == rows.count() and out.where("not exact").count() == 0
        return
    assert out.columns == rows.columns
    same = out.where(" and ".join(f"`{c}` = 'mine {c}'" for c in CLASHES)).count()
    assert same == n and stage(spark, rows.limit(0), sf).count() == 0
    if name == "pii_masking":
        assert n == rows.count()
    if name == "simhash_dedup":
        kept = [(r["doc_id"], r["text"]) for r in out.select("doc_id", "text").collect()]
        assert len([t for _, t in kept if not (t or "").strip()]) == 1 and [i for i, t in kept if t == PROSE] == [4] and (4, "another text of a repeated id") in kept
