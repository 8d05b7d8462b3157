"""Tree-reduced BPE against the tokenizer library, and exact round trips."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from marquee.llm import bpe_tree

DATA = bpe_tree.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
RANKS = bpe_tree.parse_ranks(DATA)
CODEC = bpe_tree.TreeCodec(RANKS, public_tokenizers.PATTERN)
WANT = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})

TEXTS = [
    None, "", " ", "  \n\n  a", "hello world's end", "a" * 5000, "ab" * 3000, " " * 3000 + "x", "<|endoftext|> ###$$$",
    "Éauxment oienai 𝄞𝄞 日本語のテキスト", "x\x00y\x1cz\x85   w", "1234567890" * 500, "word " * 20_000, "\n" * 400,
    "the" + "quickbrownfox" * 900, "é" * 300,
]


@pytest.mark.parametrize("text", [t for t in TEXTS if t is not None])
def test_encode_as_the_library(text):
    ids = CODEC.encode(text)
    assert ids == WANT.encode_ordinary(text)
    assert CODEC.decode(ids) == text.encode()


def test_random_texts():
    rng = random.Random(5)
    letters = "abcdeth  \n\t'sé0129#.-_ΩЖ漢 ​"
    for _ in range(400):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 120)))
        assert CODEC.encode(text) == WANT.encode_ordinary(text)
        piece = bytes(rng.randrange(256) for _ in range(rng.randint(1, 40)))
        assert CODEC.encode_piece(piece) == WANT._encode_single_piece(piece)


def test_cuts_leave_the_encoding(monkeypatch):
    monkeypatch.setattr(bpe_tree, "CUT_CHARS", 7)
    for text in TEXTS:
        short = (text or "")[:600]
        assert "".join(CODEC.cuts(short)) == short
        assert CODEC.encode(short) == WANT.encode_ordinary(short)


def test_columns(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)] + [(None, "twice", 1), (None, "twice", 1)], "doc_id long, text string, n int")
    rows = bpe_tree.digests(docs, DATA, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        ids = WANT.encode_ordinary(r["text"] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    tokens = bpe_tree.encode(docs, DATA, public_tokenizers.PATTERN)
    back = bpe_tree.decode(tokens.drop("text"), DATA)
    assert sorted((r["doc_id"] or -1, r["text"]) for r in back.collect()) == sorted((r["doc_id"] or -1, r["text"] or "") for r in docs.collect())
    assert bpe_tree.encode(docs.limit(0), DATA, public_tokenizers.PATTERN).count() == 0
    with pytest.raises(ValueError):
        bpe_tree.encode(docs, DATA, public_tokenizers.PATTERN, name="n")
