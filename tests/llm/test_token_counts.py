"""Counts after edits against encoding the edited text anew."""

import random

from vintner.llm import tokens
from vintner.llm.token_counts import CountTree, counts_after_edits, drop_repeated_lines, mask_numbers

PARTS = ["a", "b", " ", "  ", "\n", "é", "1", "23", "'s", ".", "!?", " ", "word", " word", " the", "\t", "\x1c", " "]


def edited(text, edits):
    for start, end, new in sorted(edits, reverse=True):
        text = text[:start] + new + text[end:]
    return text


def random_edits(rng, text):
    edits, at = [], 0
    while at <= len(text) and rng.random() < 0.7:
        start = rng.randint(at, min(len(text), at + 15))
        end = rng.randint(start, min(len(text), start + 10))
        edits.append((start, end, "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 4)))))
        at = end + 1
    return edits


def test_counts_stay_right_under_any_edits():
    rng, encode = random.Random(2), tokens.encoder(tokens.default_path())
    for _ in range(1500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60)))
        tree = CountTree(text, encode, leaf_chars=rng.choice([1, 3, 8]))
        for _ in range(3):
            assert tree.text == text and tree.total == len(encode(text))
            edits = random_edits(rng, text)
            tree.apply(edits)
            text = edited(text, edits)
        assert tree.text == text and tree.total == len(encode(text))


def test_counts_stay_right_around_added_tokens():
    rng, encode = random.Random(3), tokens.encoder(tokens.default_path())
    assert len(encode("a <|endoftext|>")) == 3
    for _ in range(500):
        text = "".join(rng.choice([*PARTS, "<|endoftext|>", "<|", "endoftext", "|>"]) for _ in range(rng.randint(0, 40)))
        tree = CountTree(text, encode, leaf_chars=rng.choice([1, 3, 8]))
        assert tree.total == len(encode(text))
        edits = random_edits(rng, text)
        tree.apply(edits)
        text = edited(text, edits)
        assert tree.text == text and tree.total == len(encode(text))


def test_only_touched_leaves_are_encoded_again():
    text = " ".join(f"word{i}" for i in range(5000))
    tree = CountTree(text, tokens.encoder(tokens.default_path()))
    tree.apply([(10, 12, "x"), (30000, 30003, "new words")])
    assert 0 < tree.chars_encoded_again < 1200


def test_edits_of_the_rounds():
    assert edited("call 030 123-4567 now", mask_numbers("call 030 123-4567 now")) == "call 0 now"
    assert edited("a\nb\na\n\nb\n", drop_repeated_lines("a\nb\na\n\nb\n")) == "a\nb\n"


def test_documents_against_encoding_both_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    encode = tokens.encoder(tokens.default_path())
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    n_edited = 0
    for row in counts_after_edits(docs).collect():
        text = texts[row["doc_id"]]
        assert row["n_tokens"] == len(encode(text))
        after = edited(text, mask_numbers(text))
        after = edited(after, drop_repeated_lines(after))
        assert row["n_tokens_edited"] == len(encode(after))
        n_edited += row["n_edits"] > 0
    assert n_edited > 5
