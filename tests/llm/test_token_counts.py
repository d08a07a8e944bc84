"""Compiled transducers against the tokenizer itself."""

import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.frames import awkward, empty
from tidemark.llm import token_counts
from tidemark.llm.common import text_bytes

ALPHABETS = ["ab 'sretvlmd  \n\t!1é", "aabbccdd eeeehhiinn<|endoftext|>", "a", " ", "=-_ *#\n", "日本 語ñ\u0085  ​١²Ⅷ a1!"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(token_counts.default_vocabulary())


def random_texts(n):
    rng, texts = random.Random(7), []
    for _ in range(n):
        alphabet = rng.choice([*ALPHABETS, [chr(rng.choice([rng.randrange(32, 0xD800), rng.randrange(0xE000, 0x20000)])) for _ in range(9)]])
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(rng.choice([5, 30, 300]))))
        texts.append(text + rng.choice(["", "", "<|endoftext|>", "<|endoftext|><|endof", "'ll've 'RE"]))
    return texts


def wanted(tokenizer, texts):
    return [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def counted(texts):
    data, bounds = text_bytes(pa.array(texts, pa.string()))
    return token_counts.compiled(token_counts.default_vocabulary()).count_texts(data, bounds).tolist()


@pytest.mark.parametrize("piece", [None, 150])
def test_random_texts(tokenizer, monkeypatch, piece):
    if piece:
        monkeypatch.setattr(token_counts, "PIECE_BYTES", piece)
    texts = random_texts(4000)
    assert counted(texts) == wanted(tokenizer, texts)


def test_forgotten_states_change_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(token_counts, "LANES", 256)
    monkeypatch.setattr(token_counts, "STATES", 1024)
    texts = random_texts(3000) + ["".join(random.Random(i).choice("abcdefgh") for _ in range(3000)) for i in range(3)]
    assert counted(texts) == wanted(tokenizer, texts)


def test_chunks_give_the_states_of_one_pass():
    rng = np.random.default_rng(3)
    symbols = rng.integers(0, 2 * token_counts.CLASSES**2, (40, 16)).astype(np.int32)
    state, expected = token_counts.START, []
    for row in symbols:
        expected.append(state)
        for symbol in row:
            state = token_counts.FOLLOWING[symbol * token_counts.KINDS + state]
    assert token_counts.chunk_starts(symbols).tolist() == expected


def test_documents(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = dict(zip(texts, wanted(tokenizer, list(texts.values()))))
    for row in token_counts.count_tokens(docs).collect():
        n = want[row["doc_id"]]
        assert tuple(row)[1:] == (len(texts[row["doc_id"]].encode()), n, n > 1024)


def test_awkward(spark, tokenizer):
    docs = awkward(spark)
    texts = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    want = [(k, len(t.encode()), n, n > 1024) for (k, t), n in zip(texts, wanted(tokenizer, [t for _, t in texts]))]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in token_counts.count_tokens(docs).collect())
    assert token_counts.count_tokens(empty(spark)).collect() == []


def test_other_vocabularies_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        token_counts.Compiled(public_tokenizers.path("word_bpe_49k.json"))
