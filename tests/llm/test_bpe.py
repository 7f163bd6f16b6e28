import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from perispark.llm import bpe
from tests.llm.helpers import DOCS, documents, edge_documents, table

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  a  b", "a\n b\n \n  c", " \t x", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "don't we'll I'M", "日本語 テキスト", "\x1c a \x85 b　c",
       "x   y", "🙂🙂 é é", "zzzzzz" * 100 + " !!!!!!" * 50, "\n\n\n   \n a", "a  <|endoftext|>  b", "1234 56  78", "a" * 20000, "\0 \0"]


LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture
def library():
    return LIBRARY


def same(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert bpe.encode_text(PATH, text).tolist() == ids
    assert bpe.decode_ids(PATH, ids) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ODD, ids=range(len(ODD)))
def test_odd_texts(library, text):
    same(library, text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([*"abcdefghij  \n't!12é日", "<|endoftext|>", "ing", "the"]), max_size=60).map("".join))
def test_random_texts(text):
    same(LIBRARY, text)


def test_words_without_pattern_borders(library):
    rng = random.Random(5)
    for _ in range(500):
        same(library, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(1, 80))))


def test_cut_token_decodes_to_the_replacement_mark(library):
    ids = library.encode("日", add_special_tokens=False).ids[:1]
    assert bpe.decode_ids(PATH, ids) == library.decode(ids, skip_special_tokens=False)


def test_table_matches_library(spark, library):
    got = bpe.digest_documents(documents(spark), PATH).collect()
    want = []
    for doc_id, text, *_ in edge_documents():
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert table(spark, map(tuple, got)) == table(spark, want)


def test_round_trip_and_empty_table(spark):
    docs = documents(spark)
    back = bpe.decode_documents(bpe.encode_documents(docs, PATH), PATH).select("text", "decoded").collect()
    assert all((r.text or "") == r.decoded for r in back)
    assert bpe.digest_documents(spark.createDataFrame([], DOCS), PATH).count() == 0
