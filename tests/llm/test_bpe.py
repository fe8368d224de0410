import base64
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from folioscope.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")
SIGNS = [" ", "  ", "\n", "\t", "a", "bc", "é", "ß", "1", "23", "²", "!", "'", "'s", "'ll", "'re", "'t", " ", "　", "日本", "😀", "\x1c", "x'", "don't", " '", "\r\n", "٣", "S", "​", "́"]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def mine(texts):
    merger, _, table, machine = bpe.load(PATH)
    blobs = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(b) for b in blobs])]).astype(np.int64)
    data = b"".join(blobs)
    starts = bpe.boundaries(data, off, table, machine)
    cuts = [*starts.tolist(), len(data)]
    row = np.searchsorted(starts, off)
    packed = merger([data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)])
    return [np.frombuffer(b"".join(packed[a:b]), "<u4").tolist() for a, b in zip(row, row[1:], strict=False)]


def test_like_the_library(library):
    rng = random.Random(1)
    texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 0x3000), rng.randrange(0xE000, 0x20000)])) for _ in range(20)) for _ in range(1000)]
    texts += ["<|endoftext|>", "x" * 5000, "ab" * 3000, "!?" * 300]
    assert mine(texts) == [library.encode_ordinary(t) for t in texts]


def test_round_trip(spark, library):
    rows = spark.createDataFrame([(1, "don't  stop"), (2, None), (3, ""), (3, ""), (None, "é" * 3000)], "doc_id long, text string").withColumn("ids", F.lit(7))
    out = bpe.decode(bpe.encode(rows.drop("ids"), PATH, offsets=True), PATH).collect()
    assert len(out) == 5
    for r in out:
        if r["doc_id"] == 1:
            assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode_ordinary("don't  stop")
            assert np.frombuffer(r["token_ends"], "<u8")[-1] == 11 and bytes(r["decoded"]) == b"don't  stop"
        if r["doc_id"] in (2, 3):
            assert r["n_tokens"] == 0 and bytes(r["decoded"]) == b""
    assert bpe.digests(rows.limit(0), PATH).count() == 0
    assert bpe.digests(rows, PATH).count() == 5
