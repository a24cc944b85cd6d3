import os
import random

import pytest
from pyspark.sql import functions as F

from lectern.llm import bpe

pytestmark = pytest.mark.skipif(not os.path.exists(bpe.DEFAULT_VOCABULARY), reason="no vocabulary file")
TEXTS = ["Hello world, it's  the year 2024!\n\nNew  line", "naïve café — œuvre 東京 🙂🙃", "", " ", "aaaaaaaaaaaaaaaaaaaaaaaaa" * 20, "\x00\x01 tab\tend \n", "<|endoftext|> is text", "x" * 3000, None, "don't DON'T we'll"]


def reference(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.DEFAULT_VOCABULARY)
    t.encode_special_tokens = True
    return [None if x is None else t.encode(x, add_special_tokens=False).ids for x in texts]


def test_same_ids_as_the_library_and_round_trip(documents):
    rng = random.Random(9)
    chars = "abc ABC 019 .,'\n\téßñ漢字🙂"
    texts = TEXTS + ["".join(rng.choice(chars) for _ in range(rng.randrange(1, 80))) for _ in range(60)]
    got = {r["doc_id"]: r for r in bpe.encode(documents(texts)).collect()}
    for i, want in enumerate(reference(texts)):
        assert got[i]["tokens"] == want and got[i]["same"] == (None if want is None else True) and got[i]["n_tokens"] == (None if want is None else len(want))
    back = {r["doc_id"]: r["text"] for r in bpe.decode(bpe.encode(documents(texts))).collect()}
    assert [back[i] for i in range(len(texts))] == texts


def test_long_words_are_encoded_as_the_library_does():
    rng = random.Random(3)
    words = ["x" * 200_001, "".join(rng.choice("0123456789") for _ in range(20_000)), "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200_000))]
    words += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(200_000)), "the quick brown fox jumps over lazy dogs in running water".replace(" ", "") * 500]
    words += ["".join(rng.choice(a) for _ in range(rng.randrange(256, 900))) for a in ("ab", "aeiou", "the", "=-", "漢字かな", "ก็น") for _ in range(6)]
    coder = bpe.coder(bpe.DEFAULT_VOCABULARY)
    assert coder.ordered
    assert coder.encode(words).to_pylist() == reference(words)


def test_ranks_file_gives_the_same_merges():
    path = bpe.DEFAULT_VOCABULARY.replace(".json", ".tiktoken")
    if not os.path.exists(path):
        pytest.skip("no ranks file")
    a, b = bpe.vocabulary(path), bpe.vocabulary(bpe.DEFAULT_VOCABULARY)
    assert [m for m in a[1]] == [m for m in b[1]]


def test_edges(documents):
    df = documents([(1, "a b"), (1, "a b"), (None, "c")]).withColumns({"tokens": F.lit("t"), "same": F.lit(0)})
    got = bpe.encode(df)
    assert got.columns == ["doc_id", "tokens", "n_tokens", "same"] and sorted((r["n_tokens"] for r in got.collect())) == [1, 2, 2]
    assert bpe.encode(documents([])).count() == 0
