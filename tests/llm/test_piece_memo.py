"""Pieces cut where the byte-level splitter always cuts, their flat memo, and words as bytes."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from scorelake.llm import lm, token_output
from scorelake.llm.common import PieceMemo, coded_words, read_text, tokenizer_path

BITS = ["a", "b", "s", "t", "re", "'", "'", ".", ",", "-", " ", " ", "  ", "\n", "\n\n", "\r\n", "\t", "é", "ß", "×", "÷", "ñ", "é", "Ω", "日", "\x85", "\xa0", " ", "1", "23", "<|endoftext|>",
        "<|", "|>", "\x00", "\x1c", "«", "…", "’", "ƻ", "ȿ", "😀", "²", "ª"]


def test_pieces_equal_the_library_on_whole_texts():
    box = token_output.LineUnits(read_text(tokenizer_path("byte_bpe_50k.json")))
    rng = random.Random(3)
    texts = ["".join(rng.choices(BITS, k=rng.randint(0, 25))) for _ in range(6000)]
    texts[::2] = [t.replace("<|endoftext|>", "") for t in texts[::2]]
    ids, lengths = token_output.encode_texts(box, pa.array(["x", *texts]).slice(1))
    whole = [e.ids for e in box.tokenizer().encode_batch_fast(texts, add_special_tokens=False)]
    assert lengths.tolist() == [len(w) for w in whole]
    assert ids.tolist() == [i for w in whole for i in w]


def test_a_word_goes_to_the_library_once_whatever_marks_stand_beside_it(monkeypatch):
    box = token_output.LineUnits(read_text(tokenizer_path("byte_bpe_50k.json")))
    box.tokenizer()
    asked, cut = [], box.cut
    monkeypatch.setattr(box, "cut", lambda units: asked.extend(units) or cut(units))
    token_output.encode_texts(box, pa.array(["x größe größe, größe. größe!\nx größe (größe)\nx größe's", "x größe;"]))
    assert sum("größe" in u for u in asked) == 2  # with the blank in front and without
    token_output.encode_texts(box, pa.array(["x größe: neu"]))
    assert sum("größe" in u for u in asked) == 2  # the memo holds it


def test_memo_is_bounded_and_right_after_it_drops():
    memo, asked = PieceMemo(limit=50), []

    def compute(units):
        asked.extend(units)
        return [np.arange(len(u), dtype="<u4").tobytes() for u in units]

    for turn in range(20):
        units = pa.array([f"{'x' * (k % 7)}{k}" for k in range(turn * 10, turn * 10 + 30)])
        ids, start, sizes = memo.get(units, compute)
        assert sizes.tolist() == pc.binary_length(units).to_pylist()
        assert all(ids[a:a + n].tolist() == list(range(n)) for a, n in zip(start, sizes))
        assert len(memo.texts) <= 50
    assert len(asked) < 20 * 30


def test_coded_words_as_plain_splitting():
    rng = random.Random(5)
    texts = [None if k % 17 == 0 else "".join(rng.choices(["A", "z", "É", "日", "\x1c", "\xa0", ".", " ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1f"], k=rng.randint(0, 20))) for k in range(500)]
    codes, at, words = coded_words(pa.chunked_array([pa.array(["q", *texts], pa.string()).slice(1)]))
    got = [[words[c].as_py() for c in codes[a:b]] for a, b in zip(at, at[1:])]
    assert got == [[pc.ascii_lower(w).as_py() for w in pc.ascii_split_whitespace(t or "").as_py() if w] for t in texts]
    assert len(set(words.to_pylist())) == len(words)


def test_words_of_a_chunk_come_as_flat_ids():
    """Ids of different words as one array; each core and each end is looked up once."""
    box = lm.SubwordBox(read_text(tokenizer_path("word_bpe_49k.json")))
    words = ["abc", "abc.", "abc!?", "...", "x.", "日本。", "é'", "'"]
    ids, sizes = box.coded(pa.array(words))
    parts = np.split(ids, np.cumsum(sizes)[:-1])
    assert [p.astype("<u4").tobytes() for p in parts] == box.words([w.encode() for w in words])
    assert len(box.memo.texts) == len({"abc", "...", "x", "日本。", "é", "'", ". ", "!? ", "' "})
