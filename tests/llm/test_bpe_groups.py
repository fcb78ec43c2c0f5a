"""Merges by groups of ranks against the library, on hand-made words."""

import heapq

import numpy as np

from scorelake.llm import bpe
from scorelake.llm.common import read_text, tokenizer_path

LETTERS = "aabcdeeefghiijklmnoopqrsttuuvwxyz" * 3 + "éèñßüöøŐαΣς日本'.,-$3"


def made_words(n: int, seed: int = 4) -> list[str]:
    rng = np.random.default_rng(seed)
    return ["".join(LETTERS[k] for k in rng.integers(0, len(LETTERS), rng.integers(1, 14))) for _ in range(n)]


def test_merges_go_by_groups(monkeypatch):
    """Places of a whole group of ranks merge together; before, each rank was a step of its own."""
    from tokenizers import Tokenizer

    file = tokenizer_path("word_bpe_49k.json")
    box, steps, pop = bpe.PairIndexBPE(read_text(file)).ready(), [], heapq.heappop
    words = [*made_words(4000), "a" * 301, "abab" * 50, "<|endoftext|>x", "x\x1cy\x85z", "İI"]
    monkeypatch.setattr(heapq, "heappop", lambda heap: steps.append(1) or pop(heap))
    got = box.units(words)
    tok = Tokenizer.from_file(file)
    assert got == [np.array(tok.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in words]
    assert len(steps) <= box.group.max() < 200
