"""Ids of plain words come from the vocabulary's model, and are those of the whole tokenizer."""

import random

import numpy as np

from tidemark.llm import packing


class _Whole:
    def __getattr__(self, name):
        raise AssertionError("the whole tokenizer was asked")


def test_plain_words_do_not_go_through_the_whole_tokenizer():
    units = packing.UnitIds(packing.default_vocabulary())
    text = "Abc, d\u00e9j\u00e0 \u00c9T\u00c9. it's I'D 12ab-34 0af9 \"quoted\" \u024f\u023a a"
    want = np.array(units.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    units.tokenizer = _Whole()
    assert units.encode(text) == want


def test_units_of_all_kinds_have_the_ids_of_the_whole_text():
    units = packing.UnitIds(packing.default_vocabulary())
    rng = random.Random(5)
    signs = [*map(chr, range(1, 0x250)), "<|endoftext|>", "'s", "'LL", "''", "\u0301", "\u200b", "\u2028", "\U0001f600"]
    texts = ["".join(rng.choices(signs if i % 2 else signs[:127] + signs[-8:], k=rng.randint(1, 12))) for i in range(30000)]
    whole = units.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [t for t, w in zip(texts, whole) if units.encode(t) != np.array(w.ids, "<u4").tobytes()] == []


def test_a_vocabulary_with_other_rules_is_asked_as_a_whole(tmp_path):
    with open(packing.default_vocabulary(), encoding="utf-8") as file:
        rules = file.read()
    other = tmp_path / "other.json"
    other.write_text(rules.replace('"Lowercase"', '"StripAccents"', 1), encoding="utf-8")
    units = packing.UnitIds(str(other))
    text = "Abc, d\u00e9j\u00e0 \u00c9T\u00c9. it's"
    assert units.encode(text) == np.array(units.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_units_that_leave_the_cache_are_tokenised_again(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_UNITS", 3)
    monkeypatch.setattr(packing, "CACHE_PARTS", 2)
    units = packing.UnitIds(packing.default_vocabulary())
    texts = [f"a{i} b{i} word c{i % 4}, x-{i % 3}." for i in range(40)]
    for text in texts:
        assert units.encode(text) == np.array(units.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert len(units) <= 3 + 8
