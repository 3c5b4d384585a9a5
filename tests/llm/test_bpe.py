import base64
import os
import random

import pytest

from dialoom.llm import bpe

FILE = os.path.join(bpe.TOKENIZER_DIR, "byte_bpe_50k.tiktoken")
pytestmark = pytest.mark.skipif(not os.path.exists(FILE), reason="no vocabularies here")
tiktoken = pytest.importorskip("tiktoken")

TEXTS = [None, "", " ", "\n\n  x", "It's a <|endoftext|> text, isn't it?", "日本語のテキスト", "a" * 3000, "é́​퟿", "naïve  café\t\t99.5 %", "x" * 50 + "é" * 400, "   leading and trailing   ", "№ 5 × 8 ≤ 9 👩‍💻"]


@pytest.fixture(scope="module")
def known():
    with open(FILE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return ranks, tiktoken.Encoding("own", pat_str=bpe.WORD.pattern, mergeable_ranks=ranks, special_tokens={})


def test_equals_library(known):
    ranks, library = known
    enc = bpe.Encoder(ranks)
    rng = random.Random(3)
    texts = [*TEXTS, *("".join(rng.choice("ab cdé日\n1'.") for _ in range(rng.randrange(200))) for _ in range(200))]
    for t in texts:
        want = library.encode_ordinary(t) if t else []
        assert enc.encode(t) == want and enc.count(t) == len(want)


def test_long_words_merge_alike(known):
    ranks, _ = known
    rng = random.Random(4)
    for _ in range(100):
        w = bytes(rng.choice(b"abcdestn\xc3\xa9") for _ in range(rng.randrange(1, 300)))
        assert bpe.merge_short(w, ranks) == bpe.merge_long(w, ranks)


def test_frame(spark, known):
    rows = [(i, t, "z") for i, t in enumerate(TEXTS)] + [(0, "twice", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.encode_corpus(df).collect()
    assert len(got) == len(rows) and {tuple(r["ids"]) for r in got if r["doc_id"] == 1} == {()}
    assert sorted((r["doc_id"], tuple(r["ids"])) for r in got) == sorted((i, tuple(known[1].encode_ordinary(t)) if t else ()) for i, t, _ in rows)
    assert bpe.encode_corpus(df.limit(0)).collect() == []
