"""op6_token_files: pieces cut in one byte buffer give the ids of the library, and are learned once."""

from __future__ import annotations

import numpy as np
import pytest

from donorlens.llm import queries, token_files, tokens

PATH = queries.vocabulary("word_bpe_49k.json")


@pytest.fixture
def words():
    return tokens.WordTokenizer(PATH)


def by_library(texts):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    return [np.array(e.ids, "<u4").tobytes() for e in found]


@pytest.mark.parametrize("texts", [
    ["", " ", "\n\t", "one", "", " One  two\r\n"],
    ["Don't, don't; DON'T *'s x's' 's5 5's ''re l'Été (f(b)) a1b22 ***end*** x@y.z"],
    ["ẖ H̱a", "Å. İİ ſ Σς ªBºµ 2×3÷Z ßẞ ≠ .́x"],
    ["a b a B c\u0085d e\x1cf g\x00H 　", "Café’s “Naïve” 中文Text \U0001f600!"],
    ["<|endoftext|> A", "<|ENDOFTEXT|>", "x<|startoftext|>y <|", "plain after"],
])
def test_ids_are_the_library_s(words, texts):
    assert words.encode(texts) == by_library(texts)
    assert words.encode(texts[::-1]) == by_library(texts[::-1])  # now out of the cache


def test_ids_stay_when_the_cache_turns_over(words, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 20)
    rng = np.random.default_rng(3)
    for _ in range(30):
        texts = [" ".join("".join(rng.choice(list("abc,.é'"), 3)) for _ in range(12)) for _ in range(3)]
        assert words.encode(texts) == by_library(texts)
        assert len(words.recent) < 20 + 12 * 3 * 3


def test_a_word_in_many_guises_is_learned_once(words, monkeypatch):
    learned = []
    learn = words._learn
    monkeypatch.setattr(words, "_learn", lambda pieces: (learned.extend(pieces), learn(pieces))[1])
    texts = ["harbour Harbour HARBOUR harbour, (harbour) harbour*** \"Harbour\" harbour7 harbour's", "Été. été!"]
    assert words.encode(texts) == by_library(texts)
    assert [p for p in learned if "arbour" in p.lower()] == ["harbour"]
    assert [p for p in learned if "té" in p.lower()] == ["été"]


@pytest.mark.parametrize("width", range(33))
def test_bits_of_every_width(width):
    rng = np.random.default_rng(width)
    for n in (1, 7, 8, 65, 4096):
        values = rng.integers(0, 1 << width, n, dtype=np.uint64).astype(np.uint32)
        assert (token_files.unpack_bits(token_files.pack_bits(values, width), n, width) == values).all()
