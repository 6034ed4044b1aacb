"""The fast encoder against the library, on random texts of both vocabularies."""

import hashlib
import itertools
import json
import random
from array import array

import pytest

from rillsync.llm import subwords
from rillsync.llm.subwords import encoder, vocabulary_path

PARTS = [
    "word", "Word", "WORD", "été", "ß", "中文", "тест", "x1", "1234567", "don't", "it's", "a-b", "a_b", "<|endoftext|>",
    "<|startoftext|>", "", "Ġ", "é", "​", "﻿", "ﬁ", "İ", "ſ", "K", "🙂", ".", ",", "!", "...",
    "(", ")", '"', "'", " ", "  ", "   ", "\n", "\n\n", "\t", "\r\n", "\xa0", " ", "\x00", "\x1c", "aaaaaaaaaaaaaaaaaaaa",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_the_library(name):
    tool, rng = encoder(vocabulary_path(name)), random.Random(40)
    texts = ["".join(rng.choice(PARTS) + rng.choice(["", " ", " "]) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    want = [array("I", e.ids).tobytes() for e in tool.library.encode_batch(texts, add_special_tokens=False)]
    got = tool.ids_of(texts)
    assert [t for t, a, b in zip(texts, want, got, strict=True) if a != b] == []


def _merged(parts: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Plain byte-pair encoding by named merges: the first pair of least rank is joined until none is named."""
    while True:
        rank, at = min(((ranks.get(p, len(ranks)), k) for k, p in enumerate(itertools.pairwise(parts))), default=(len(ranks), 0))
        if rank == len(ranks):
            return parts
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_every_token_is_joined_from_its_own_bytes(name):
    path = vocabulary_path(name)
    with open(path, "rb") as f:
        data = f.read()
    assert hashlib.sha256(data).hexdigest() in subwords.PROVEN
    model = json.loads(data)["model"]
    ends, vocabulary, merges = model["end_of_word_suffix"] or "\0", model["vocab"], [tuple(m) for m in model["merges"]]
    ranks = {m: k for k, m in enumerate(merges)}
    letters = len(vocabulary) - len(merges)
    assert [vocabulary["".join(m)] for m in merges] == list(range(letters, len(vocabulary)))
    for token in vocabulary:
        parts = list(token.removesuffix(ends))
        if token.endswith(ends):
            parts[-1] += ends
        assert _merged(parts, ranks) == [token]
    assert len({subwords.token_bytes(t, model["end_of_word_suffix"]) for t in vocabulary}) == len(vocabulary)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_with_signs_and_newlines_need_no_library(name, monkeypatch):
    tool, rng = subwords.Encoder(vocabulary_path(name)), random.Random(41)
    made = ["".join(rng.choice("abehinorstäéñßÈMµ") for _ in range(rng.choice([1, 2, 5, 9, 14, 120]))) for _ in range(3000)]
    texts = [
        " ".join(w + rng.choice(["", "", ".", ",%%%", "&&&", "...", "'", "\n" + w, "!\n" + w + ".\n" + w]) for w in made[k : k + 30])
        for k in range(0, 3000, 30)
    ]
    want = [array("I", e.ids).tobytes() for e in tool.library.encode_batch(texts, add_special_tokens=False)]
    for tail in (".", ",%%%", "&&&", "...", "'", "!"):
        tool.signs[tail] = tool._library([tail])[0]
    monkeypatch.setattr(tool, "_library", None)  # a call is an error
    assert tool.ids_of(texts) == want


def test_the_table_of_chunks_is_bounded(monkeypatch):
    monkeypatch.setattr(subwords, "CACHE_CHUNKS", 50)
    tool = subwords.Encoder(vocabulary_path("byte_bpe_50k.json"))
    text = "a " + " ".join(f"w{k}" for k in range(500))
    assert tool.ids_of([text, text]) == [array("I", tool.library.encode(text).ids).tobytes()] * 2
    assert len(tool.kept) <= 50


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_other_vocabularies_keep_to_the_library(name, monkeypatch):
    monkeypatch.setattr(subwords, "PROVEN", set())
    tool = subwords.Encoder(vocabulary_path(name))
    assert tool.joined is None
    texts = ["Été d'enbeß,%%% ÀÉ\nword&&& Word.", "a b µª x!\nÿ"]
    want = [array("I", e.ids).tobytes() for e in tool.library.encode_batch(texts, add_special_tokens=False)]
    assert tool.ids_of(texts) == want


def test_words_of_many_texts_are_looked_up_once(monkeypatch):
    tool, rng = subwords.Encoder(vocabulary_path("word_bpe_49k.json")), random.Random(41)
    letters = ["".join(rng.choices("abcdeEnrstT", k=rng.randint(1, 12))) for _ in range(300)]
    pieces = [*letters, *(w + rng.choice([".", ",", '."', "'s"]) for w in letters[:100]), *PARTS]
    texts = ["", *(rng.choice([" ", "\n", "\t", "  "]).join(rng.choices(pieces, k=rng.randint(0, 40))) for _ in range(600))]
    want = [array("I", e.ids).tobytes() for e in tool.library.encode_batch(texts, add_special_tokens=False)]
    met, get = [], tool._known
    monkeypatch.setattr(tool, "_known", lambda words: met.append(words) or get(words))
    assert tool.ids_of(texts) == want and all(len(w) == len(set(w)) for w in met) and len(met) == 1
    monkeypatch.setattr(subwords, "AT_ONCE", 500)  # few texts at once, and a small table
    monkeypatch.setattr(subwords, "CACHE_CHUNKS", 50)
    tool.kept.clear()
    assert tool.ids_of(texts) == want and len(met) > 10 and len(tool.kept) <= 50
    assert tool.ids_of([]) == []
