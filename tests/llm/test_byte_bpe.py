import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from filehaul.llm import byte_bpe
from filehaul.llm.queries import RANKS, op8_byte_bpe

from .conftest import DATA


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(public_tokenizers.path(RANKS))


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_query_matches_the_library(spark, documents, reference):
    found = {row["doc_id"]: row for row in op8_byte_bpe(spark, DATA).collect()}
    for row in documents.collect():
        ids = reference.encode_ordinary(row["text"])
        got = found[row["doc_id"]]
        assert got["n_tokens"] == len(ids)
        assert got["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got["decoded_sha256"] == hashlib.sha256(row["text"].encode()).hexdigest()


def test_random_pieces(ranks, reference):
    import regex

    vocabulary = byte_bpe.Vocabulary(ranks)
    source = random.Random(1)
    letters = ["a", "b", "the", "ing", " ", "\n", "1", "!", "é", "漢", "😀", "\x1c", "\x85", "'s", "x" * 40, "=" * 9]
    for _ in range(300):
        text = "".join(source.choice(letters) for _ in range(source.randint(0, 80)))
        pieces = regex.findall(public_tokenizers.PATTERN, text)
        got = np.concatenate([np.zeros(0, int), *vocabulary.encode_pieces([p.encode() for p in pieces])])
        assert got.tolist() == reference.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 900, "漢字" * 300, "=" * 1001])
def test_long_pieces(ranks, reference, text):
    merged = byte_bpe.Vocabulary(ranks)._merge_long(text.encode())
    assert merged.tolist() == reference.encode_ordinary(text)


def test_odd_rows(spark, odd, empty):
    vocabulary = byte_bpe.load_vocabulary(spark, public_tokenizers.path(RANKS))
    coded = byte_bpe.encode(odd, vocabulary, public_tokenizers.PATTERN)
    back = byte_bpe.decode(coded, vocabulary).collect()
    texts = sorted((row["text"] or "").encode() for row in odd.collect())
    assert sorted(bytes(row["body"]) for row in back) == texts
    assert sum(row["n_tokens"] == 0 for row in back) == 3
    assert byte_bpe.encode(empty, vocabulary, public_tokenizers.PATTERN).count() == 0
