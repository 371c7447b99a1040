import random

import public_tokenizers
import tokenizers
from pyspark.sql import functions as F

from servicerank.llm import bpe, token_counts
from servicerank.llm.token_counts import EDITS, CountedText, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
REFERENCE = tokenizers.Tokenizer.from_file(PATH)
PIECES = ["the ", "and ", "'ll", "'s", " ", "  ", "\n", "a", "tion", "!!!", "12", "漢", "<|endoftext|>", "<|endof", "text|>", "՘x", "é"]


def full(text):
    return len(REFERENCE.encode(text, add_special_tokens=False).ids)


def applied(text, start, stop, replacement):
    start = min(max(start, 0), len(text))
    return text[:start] + replacement + text[min(max(stop, start), len(text)) :]


def test_counts_follow_random_edits():
    tokenizer, rng = bpe.load(PATH), random.Random(3)
    made = lambda n: "".join(rng.choice(PIECES) for _ in range(rng.randint(0, n)))
    for _ in range(150):
        text = made(rng.choice([3, 30, 400, 3000]))
        pieces = tokenizer.cut(text)
        tokenizer.learn([pieces])
        counted = CountedText(tokenizer, text, pieces)
        assert counted.n_tokens == full(text)
        for _ in range(rng.randint(1, 6)):
            start = rng.randint(-2, len(text) + 3)
            edit = (start, start + rng.choice([0, 0, 1, 2, 5, 50, 3000]), made(rng.choice([0, 1, 3, 8, 600])))
            text = applied(text, *edit)
            counted.edit(*edit)
            if rng.random() < 0.5:
                tokenizer.learn(counted.pending.values())
                counted.settle()
        tokenizer.learn(counted.pending.values())
        counted.settle()
        assert counted.text == text and counted.n_tokens == full(text) and counted.lengths[1] == len(text)


def test_only_the_neighbourhood_is_encoded_again():
    tokenizer = bpe.load(PATH)
    text = "the words of a long text " * 20_000
    pieces = tokenizer.cut(text)
    tokenizer.learn([pieces])
    counted = CountedText(tokenizer, text, pieces)
    counted.edit(200_000, 200_010, "Z")
    assert counted.encoded < 20 * token_counts.BLOCK * 10


def test_table_of_edits(make, spark):
    docs = make([(1, "one two three"), (2, None), (3, "x" * 40_000), (1, "one two three"), (4, "")])
    edits = spark.createDataFrame(
        [(1, 2, 0, 3, "ONE"), (1, 1, 4, 7, ""), (2, 1, 5, 9, "new text"), (9, 1, 0, 1, "q"), (3, 1, 10, None, None)],
        "doc_id long, seq int, start long, stop long, replacement string",
    )
    got = {r.doc_id: r for r in count_tokens(docs, PATH, edits).collect()}
    want = {1: "ONE  three", 2: "new text", 3: "x" * 40_000, 4: ""}
    assert {i: r.edited for i, r in got.items()} == want
    for i, r in got.items():
        assert r.n_tokens_edited == full(want[i])
    assert count_tokens(docs, PATH, edits).count() == 5


def test_column_of_edits_and_no_edits(documents, make):
    edits = F.array(F.struct(F.lit(3).alias("start"), F.lit(9).alias("stop"), F.lit("abc").alias("replacement"))).cast(EDITS)
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in count_tokens(documents, PATH, edits).collect():
        assert r.edited == applied(texts[r.doc_id], 3, 9, "abc") and r.n_tokens_edited == full(r.edited)
        assert r.n_tokens == full(texts[r.doc_id])
    assert [r.n_edits for r in count_tokens(make([(1, "a")]), PATH).collect()] == [0]
    assert count_tokens(make([]), PATH).collect() == []
