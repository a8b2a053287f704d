import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from linkweave.llm import bpe

from cases import TEXTS, documents

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    found = library.encode(text, add_special_tokens=False).ids
    decoded = library.decode(found, skip_special_tokens=False)
    return len(found), *(
        hashlib.sha256(t.encode()).hexdigest() for t in (" ".join(map(str, found)), decoded)
    )


def test_documents_as_the_library(spark, library):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in df.collect()}
    got = {r.doc_id: r for r in bpe.encode(df).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        assert tuple(got[i])[1:] == expected(library, text)


def test_cases_as_the_library(spark, library):
    got = sorted(map(tuple, bpe.encode(documents(spark)).collect()), key=str)
    assert got == sorted(((i, *expected(library, t or "")) for i, t in TEXTS), key=str)
    assert bpe.encode(documents(spark).limit(0)).count() == 0


@pytest.mark.parametrize("text", [
    "", " ", "aaaaaaa", "ab" * 3000, "don't WE'LL I'M 'S", "x\x1cy \x85z᠎q", "é é", "1234 5",
    "_a_ \U000e0101 ͸", "日本語のテキスト", "<|endoftext|><|endoftext|> <|end", "ΟΔΟΣ ς",
])
def test_odd_texts_as_the_library(library, text):
    ids, tokens = next(bpe.encode_texts([text], bpe.words_of(PATH)))
    found = library.encode(text, add_special_tokens=False).ids
    assert ids == " ".join(map(str, found))
    assert tokens == library.decode(found, skip_special_tokens=False)


def test_every_code_point_as_the_library(library):
    """Alone and between letters; also those that newer Unicode versions have added."""
    codes = [chr(c) for c in range(0x40000) if not 0xD800 <= c < 0xE000] + [chr(c) for c in range(0xE0000, 0xE01F0)]
    words = bpe.words_of(PATH)
    for start in range(0, len(codes), 4096):
        texts = [f"x{c}y {c}{c} 1{c}" for c in codes[start:start + 4096]]
        found = library.encode_batch(texts, add_special_tokens=False)
        for text, (ids, _), wanted in zip(texts, bpe.encode_texts(texts, words), found, strict=True):
            assert ids == " ".join(map(str, wanted.ids)), ascii(text)
        words.forget()


def test_index_against_one_word_at_a_time():
    """The index over many words gives what merging each word alone gives."""
    words = bpe.words_of(PATH)
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("aabetnho"), rng.integers(1, 12))) for _ in range(300)]

    def alone(word):
        ids = words.encode_words([word])[0] if len(word) == 1 else None
        if ids is not None:
            return ids
        raw = word.encode()
        ids = [int(words.inner[b]) for b in raw[:-1]] + [int(words.last[raw[-1]])]
        while True:
            best = None
            for i in range(len(ids) - 1):
                known, ranks = words.merges.find(np.array(ids[i:i + 1]), np.array(ids[i + 1:i + 2]))
                if len(known) and (best is None or ranks[0] < best[0]):
                    best = int(ranks[0]), i
            if best is None:
                return ids
            rank, i = best
            ids[i:i + 2] = [int(words.merges.new[rank])]

    assert words.encode_words(texts) == [alone(t) for t in texts]


def test_kept_pieces_are_forgotten(monkeypatch):
    words = bpe.Words(PATH)
    monkeypatch.setattr(bpe, "KEPT_PIECES", 3)
    list(bpe.encode_texts(["a b c d e"], words))
    assert not words.ids_of
