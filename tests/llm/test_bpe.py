import random

import public_tokenizers
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from servicerank.llm import bpe
from servicerank.llm.bpe import encode_decode

PATH = public_tokenizers.path("byte_bpe_50k.json")
REFERENCE = tokenizers.Tokenizer.from_file(PATH)
ODD = [
    None, "", "   ", "a  b\n\n c \t", "<|endoftext|>", "x <|endoftext|> y<|endoftext|>", "<|endof", "'ll've 'x I'll  ", "a" * 5000,
    "\x1c\x1d a\x85b  \xa0 c", "½ Ⅷ ٣ 漢字 é é", "!!!???" * 50, "\U0001f600\U0001f469‍\U0001f680", "word " * 20_000, "՘x \U0003d000",
]


def expected(text):
    return REFERENCE.encode(text or "", add_special_tokens=False).ids


def encoded(text):
    tokenizer = bpe.load(PATH)
    words = tokenizer.cut(text)
    tokenizer.learn([words])
    return tokenizer.ids(words)[0].tolist() if words else []


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_text_is_encoded_as_the_library_does(text):
    assert encoded(text) == expected(text)


@given(st.text(alphabet="aab'lrst \n\t.,!é漢<|>endoftx", max_size=60))
@settings(max_examples=300, deadline=None)
def test_repetitive_text_is_encoded_as_the_library_does(text):
    assert encoded(text) == expected(text)


def test_a_worker_that_forgets_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    rng = random.Random(1)
    for _ in range(50):
        text = " ".join(rng.choice(["the", "thondha", "ereat", "x!"]) for _ in range(20))
        assert encoded(text) == expected(text)
    bpe.load(PATH).forget()


def test_long_words_merge_alike():
    tokenizer = bpe.load(PATH)
    for word in (b"ababab" * 200, "çé".encode() * 100, b"x" * 3000):
        assert tokenizer.merge_long(word) == tokenizer.merge(word)


def test_operator_gives_ids_and_the_decoded_text(make):
    rows = list(enumerate(ODD)) + [(0, None)]
    got = encode_decode(make(rows), PATH, tuple(bpe.OUTPUTS)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = ODD[r.doc_id] or ""
        assert r.ids == expected(text) and r.n_tokens == len(r.ids)
        assert r.decoded == REFERENCE.decode(r.ids, skip_special_tokens=False) == text


def test_documents_and_empty_table(documents, make):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in encode_decode(documents, PATH, ("ids",)).collect():
        assert r.ids == expected(texts[r.doc_id])
    assert encode_decode(make([]), PATH).collect() == []


@pytest.mark.parametrize("text", ["a", "<|endoftext|>", "two words"])
def test_decode_inverts(text):
    assert bpe.load(PATH).decode(encoded(text)).decode() == text
