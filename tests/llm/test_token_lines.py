"""Pieces given to the library as lines against pieces given alone."""

import numpy as np

from scorelake.llm import token_output
from scorelake.llm.common import read_text, tokenizer_path

LETTERS = "aabcdeeefghiijklmnoopqrsttuuvwxyz" * 3 + "éèñßüöøŐαΣς日本'.,-$3"


def made_words(n: int, seed: int = 4) -> list[str]:
    rng = np.random.default_rng(seed)
    return ["".join(LETTERS[k] for k in rng.integers(0, len(LETTERS), rng.integers(1, 14))) for _ in range(n)]


def test_pieces_go_to_the_library_as_lines(monkeypatch):
    """Many pieces to a call of the library, with the ids each gets alone; before, each piece was a call's text of its own."""
    box = token_output.LineUnits(read_text(tokenizer_path("byte_bpe_50k.json")))
    box.tokenizer()
    units = [" " + w for w in made_words(2000)] + ["a\nb", " a.\nb's\n'c", "a\n\nb", "\n", " ", "", " a\n", "x<|endoftext|>y", " x<|endoftext|>", "a\x85b", "\x1c", " don't", "'s"]
    alone, sent = box.ids(units), []
    ids = box.ids
    monkeypatch.setattr(box, "ids", lambda texts: sent.extend(texts) or ids(texts))
    assert box.cut(units) == alone
    assert len(sent) < len(units) / 20
