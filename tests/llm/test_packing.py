"""Packing."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docsentinel.llm.packing import WordEncoder, binary_cuts, pack


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_edge_rows_round_trip(edge_docs, edge_rows, tokenizer):
    rows = pack(edge_docs, with_ids=True).collect()
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows)))
    assert all(r["offset"] == 0 and r["length"] & (r["length"] - 1) == 0 and r["length"] <= 4096 for r in rows)
    by_size = sorted(rows, key=lambda r: r["sequence_id"])
    assert [r["length"] for r in by_size] == sorted((r["length"] for r in rows), reverse=True)
    for key, text in {r[:2] for r in edge_rows}:
        want = ids_of(tokenizer, text)
        copies = sum(r[0] == key for r in edge_rows)
        own = sorted((r for r in rows if r["doc_id"] == key), key=lambda r: r["start"])[::copies]
        assert [i for r in own for i in r["ids"]] == want
        assert all(r["doc_tokens"] == len(want) for r in own)
        assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in own)


def test_words_encode_like_whole_texts(tokenizer):
    texts = [
        "It's Élan vital: naïve CAFÉ.. a,b. c! 3.14 x́ İ ẞ  z q\x1cr ﻿", "I'LL we'd they're 've 's",
        "Ünïcödé straße ÿ× ÷ µ ª", "…— “q” 🙂👍🏽 é. K", "<|endoftext|>x <|ENDOFTEXT|> <|startoftext|>", "\x85a\x0bb\x0cc",
    ]
    encoder = WordEncoder(None, 2)
    got = encoder.encode([t.encode() for t in texts])
    assert [g.tolist() for g in got] == [ids_of(tokenizer, t) for t in texts]


def test_binary_cuts():
    assert binary_cuts(1, 4096) == [(0, 1)]
    assert binary_cuts(13, 4) == [(0, 4), (4, 4), (8, 4), (12, 1)]
    for n in range(1, 300):
        cuts = binary_cuts(n, 64)
        assert [a for a, _ in cuts] == np.cumsum([0, *[s for _, s in cuts]])[:-1].tolist() and sum(s for _, s in cuts) == n


def test_null_keys_empty_table_and_bad_sizes(null_key_docs, no_docs):
    rows = pack(null_key_docs).collect()
    assert (None, 0, 1, 1) in {(r["doc_id"], r["start"], r["length"], r["doc_tokens"]) for r in rows}
    assert pack(no_docs).collect() == []
    with pytest.raises(ValueError):
        pack(no_docs, most=100)
