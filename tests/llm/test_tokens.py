"""Ids of words by the tokenizer file's ranks, and the cache of pieces."""

import json
import unicodedata

import public_tokenizers
import pytest

from barline.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def cache():
    return tokens.PieceCache(PATH)


def test_every_token_is_what_its_own_merges_lead_to():
    """Then a pair whose join is a token is one of the merges wherever it stands, and ranks give the tokenizer's ids."""
    with open(PATH, encoding="utf-8") as f:
        model = json.load(f)["model"]
    order = {tuple(m if isinstance(m, list) else m.split(" ")): k for k, m in enumerate(model["merges"])}
    for token in model["vocab"]:
        if token.startswith("<|") and token.endswith("|>"):
            continue
        last = token.endswith(tokens.END) and len(token) > len(tokens.END)
        parts = list(token.removesuffix(tokens.END) if last else token)
        parts[-1] += tokens.END if last else ""
        while len(parts) > 1:
            k = min(range(len(parts) - 1), key=lambda i: order.get((parts[i], parts[i + 1]), len(order)))
            assert (parts[k], parts[k + 1]) in order, token
            parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_ids_are_those_of_the_whole_tokenizer(cache):
    words = ["a", "straße", "éa", "naïve", "x" * 64, "x" * 65, "THE!!", "l'été,", "don't", "Ünder***", "日本a", "aaaaaaaaa", "z" + "é" * 40 + "b", "<|endoftext|>a", "İa", "ΣΑΣa", "a_b", "__", "!?", ""]
    for text in [*words, " ".join(words), " ".join(w[::-1] for w in words)]:
        for _ in range(2):
            ids = cache.encode(text)
            assert [int.from_bytes(ids[k : k + 4], "little") for k in range(0, len(ids), 4)] == cache.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_a_word_is_kept_once(cache):
    cache.clear()
    cache.encode("gleamingly Gleamingly gleamingly,")
    assert sorted(cache) == [",", "Gleamingly", "gleamingly", "gleamingly,"] and not hasattr(cache, "words")


def test_lower_case_of_normal_letters_is_normal():
    """So a lowered word may be looked up as a piece."""
    normal = lambda c: unicodedata.is_normalized("NFC", c)
    assert not [c for c in map(chr, range(0x110000)) if c.isalpha() and normal(c) and not normal(c.lower()) and c not in tokens.SIGMA]
