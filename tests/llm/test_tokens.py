import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.llm.tokens import UnitEncoder, char_batches

NAMES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ENCODERS = {n: UnitEncoder(n) for n in NAMES}
HARD = ["", " ", "a", " a", "a ", "a  b", "don't  stop", "it's", "x 'tis 12'3 4", "it's <|endoftext|> b\n\nc ", "ab́c x", "1234 567 8",
        "² xⅧy", "A\tb", "a\nb c\n\nd", "\n", "a \nb", "Straße Été!! ... %% a,b", "×÷ a", "a\x1cb", "中文 a", "a b",
        "x" * 3000, "w " * 500 + "end", "<|startoftext|>", "\U0001f600 hi", "12 34", "a.b.c 1.2", "İ İ"]
ALPHABET = st.sampled_from(list("abZ 9.\n!'éÀ×́²\t 中<|>İ") + ["the", " of", "<|endoftext|>", "  "])


def _check(enc, texts):
    ids, lens = enc.encode(texts)
    assert len(lens) == len(texts) and lens.sum() == len(ids)
    at = 0
    for t, n in zip(texts, lens):
        assert enc.tok.encode(t, add_special_tokens=False).ids == ids[at:at + n].tolist(), repr(t)
        at += n


@pytest.mark.parametrize("name", NAMES)
def test_hard_texts(name):
    _check(ENCODERS[name], HARD)
    for t in HARD:
        _check(ENCODERS[name], [t])


@pytest.mark.parametrize("name", NAMES)
@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.lists(ALPHABET, max_size=30).map("".join), max_size=6))
def test_equal_to_the_library(name, texts):
    if texts:
        _check(ENCODERS[name], texts)


def test_small_table_still_exact(monkeypatch):
    monkeypatch.setattr(UnitEncoder, "SLOTS", 8)
    monkeypatch.setattr(UnitEncoder, "LIMIT", 20)
    enc = UnitEncoder(NAMES[0])
    rng = np.random.default_rng(0)
    for _ in range(5):
        _check(enc, [" ".join(f"w{k}" for k in rng.integers(0, 60, 40)) for _ in range(3)])


def test_char_batches_cover_everything():
    for lengths in ([], [5], [3, 3, 3], [10, 0, 0, 10], [0] * 7):
        got = [i for s in char_batches(lengths, 6) for i in range(s.start, s.stop)]
        assert got == list(range(len(lengths)))
