import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tremor.llm import encoding

pytestmark = pytest.mark.skipif(not os.path.exists(os.path.join(encoding.VOCABULARIES, encoding.DEFAULT)), reason="no vocabulary files here")


@pytest.fixture(scope="module")
def enc():
    return encoding.encoder()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(os.path.join(encoding.VOCABULARIES, "byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_same_as_the_library_and_back(text):
    from tokenizers import Tokenizer

    enc = encoding.encoder()
    assert enc.decode(enc.encode(text)) == text
    global _TOKENIZER
    try:
        _TOKENIZER
    except NameError:
        _TOKENIZER = Tokenizer.from_file(os.path.join(encoding.VOCABULARIES, "byte_bpe_50k.json"))
        _TOKENIZER.encode_special_tokens = True
    assert enc.encode(text) == _TOKENIZER.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["", " ", "<|endoftext|>", "a" * 5000, " \n" * 300, "0" * 999, "ñandú 轴承温度偏高 🏭", "'ll 've it's"])
def test_special_cases(enc, library, text):
    assert enc.encode(text) == library(text)


def test_null(enc):
    assert enc.encode(None) == []


def test_each_prefix_has_one_last_token(enc):
    """The stored last token of a prefix is that of the prefix encoded alone."""
    data = b" unbelievable"
    last = enc.last_tokens(data)
    for n in range(1, len(data) + 1):
        assert last[n - 1] == enc.piece(data[:n])[-1]
    assert enc.last_tokens(data, last[:5]) == enc.last_tokens(data)


def test_append_and_edit(enc):
    rng = random.Random(3)
    letters = "ab c1'é\n "
    for _ in range(200):
        text = encoding.EncodedText(enc, "".join(rng.choice(letters) for _ in range(rng.randint(0, 30))))
        for _ in range(4):
            i = rng.randint(0, len(text.text))
            j = min(len(text.text), i + rng.randint(0, 5))
            text.replace(i, j, "".join(rng.choice(letters) for _ in range(rng.randint(0, 6))))
            assert text.ids == enc.encode(text.text)
        text.append(" more of it")
        assert text.ids == enc.encode(text.text)


def test_documents(spark, enc):
    docs = spark.createDataFrame([(1, "Hello world", "x"), (2, None, "y"), (3, "", None), (3, "  ", "z")], "doc_id long, text string, ids string")
    got = {(r["doc_id"], tuple(r["ids"])) for r in encoding.encode_documents(docs).collect()}
    assert got == {(1, tuple(enc.encode("Hello world"))), (2, ()), (3, ()), (3, tuple(enc.encode("  ")))}
    assert encoding.encode_documents(docs.limit(0)).count() == 0
    assert dict(encoding.encode_documents(docs).dtypes) == {"doc_id": "bigint", "ids": "array<int>"}


def test_other_vocabulary(library):
    multi = encoding.encoder("byte_bpe_multi_50k.tiktoken")
    import tiktoken

    own = tiktoken.Encoding("own", pat_str=encoding.PIECES, mergeable_ranks=multi.ranks, special_tokens={})
    for text in ("Guten Morgen, señor", "Überprüfung 123", "naïve café"):
        assert multi.encode(text) == own.encode_ordinary(text)
