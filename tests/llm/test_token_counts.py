"""Token counts of words without blanks, against the library."""

from __future__ import annotations

import random
import time

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from callsheet.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "0123456789abcdef", "a", "-=", "漢字é", "\x00\x7f"])
def test_long_words_equal_the_library(letters):
    rng, machine, lib = random.Random(1), token_counts.counter(PATH), Tokenizer.from_file(PATH)
    words = ["".join(rng.choice(letters) for _ in range(n)) for n in (1, 60, 255, 256, 257, 300, 5000)]
    texts = [*words, " ".join(words), "x " + "\n".join(words)]
    got = machine.count([t.encode() for t in texts])
    assert got.tolist() == [len(lib.encode(t, add_special_tokens=False).ids) for t in texts]


def test_walked_and_stepped_words_agree():
    rng, machine = random.Random(2), token_counts.counter(PATH)
    words = ["".join(rng.choice("etaoin shrdlu'ABC019é"[:n]) for _ in range(rng.randint(1, 90))).replace(" ", "_") for n in (6, 12, 20) for _ in range(100)]
    for w in words:
        raw = w.encode()
        assert machine.merger.walk(raw.decode("latin-1")) == len(machine.merger.merge(raw.decode("latin-1")))


def test_one_word_of_half_a_million_bytes():
    rng = random.Random(3)
    word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCXYZ0123456789+/") for _ in range(500_000))
    started = time.time()
    assert token_counts.counter(PATH).count([word.encode()])[0] > 100_000
    assert time.time() - started < 30
