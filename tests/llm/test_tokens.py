import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from mirrorset.llm import bpe, packing

ODD = [
    "it's a 'sfoo''s I'll  two   \n\n x\t y ",
    "",
    None,
    "<|endoftext|>hi<|startoftext|> a<|endoftext|>",
    "ΑΣ Σς İstanbul ÀÉ 12ab34 ½ x²",
    "日本語テキスト。 한국어",
    "aaaa aaaaaaa bananana aaaaaaaaaaaaaaaaaaaaaaaaaaaa",
    " 's 't'd we're x　y  ",
    "é café",
    "😀😀!!!   ",
    "'",
    "don't'",
    " ' s",
    "\n",
    "  \n  ",
    "\x00a\x00\x00b\x1c c",
    "MiXeD cAsE'S'LL",
    "long " * 30_000,
]


def tokenizer(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def numbered(texts):
    return list(enumerate(texts))


@pytest.fixture(scope="module")
def texts(documents):
    return ODD + ODD[:3] + [r.text for r in documents.collect()]


def test_encode_and_decode_as_the_library(make_documents, texts):
    library = tokenizer("word_bpe_49k.json")
    rows = bpe.encode_decode(make_documents(numbered(texts)), public_tokenizers.path("word_bpe_49k.json")).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_pieces_hold_each_id_once(make_documents, texts):
    library = tokenizer("byte_bpe_50k.json")
    rows = packing.pack(make_documents(numbered(texts)), public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert len({r.sequence_id for r in rows}) == len(rows) and all(r.offset == 0 for r in rows)
    assert all(r.length == 2**r.bucket <= 1024 for r in rows)
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, []).append(r)
    assert set(of) == set(range(len(texts)))
    for i, pieces in of.items():
        ids = np.array([*library.encode(texts[i] or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def thue_morse(n, letters="ab"):
    word = letters[0]
    while len(word) < n:
        word += "".join(letters[1 - letters.index(c)] for c in word)
    return word


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_words_with_equal_hashes_stay_apart(name):
    """A Thue-Morse word and its complement have equal polynomial hashes modulo 2^64."""
    import pyarrow as pa

    library, encoder = tokenizer(name), bpe.Encoder(public_tokenizers.path(name))
    pairs = [(thue_morse(n, "ab"), thue_morse(n, "ba")) for n in (1_024, 2_048)]
    texts = [f"{a} {b} {a}" for a, b in pairs] + [b for _, b in pairs] + [a for a, _ in pairs]
    for part in (texts, texts[::-1], texts[2:4], texts[4:]):
        for _, ids, _ in encoder.encoded([pa.record_batch([pa.array(part)], ["text"])], "text"):
            assert [x.tolist() for x in ids] == [library.encode(t, add_special_tokens=False).ids for t in part]


def test_empty_table_and_clashing_columns(make_documents):
    empty = make_documents([])
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert packing.pack(empty, path).count() == 0
    assert bpe.encode_decode(empty, path).count() == 0
    more = make_documents([(None, "a b"), (1, None)]).selectExpr("*", "'x' AS id", "1 AS n_tokens", "2 AS bucket")
    assert packing.pack(more, path).count() == 3
    assert bpe.encode_decode(more, path).count() == 2


def test_the_worker_forgets_words_beyond_its_bound(monkeypatch):
    monkeypatch.setattr(bpe, "_KNOWN_WORDS", 10)
    import pyarrow as pa

    encoder = bpe.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    library = tokenizer("byte_bpe_50k.json")
    for n in range(3):
        texts = [f"word{i} other{n}" for i in range(20)]
        batch = pa.record_batch([pa.array(texts)], ["text"])
        for _, ids, _ in encoder.encoded([batch], "text"):
            assert [x.tolist() for x in ids] == [library.encode(t, add_special_tokens=False).ids for t in texts]
