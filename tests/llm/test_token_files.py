import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import no_docs, odd_docs
from tidemark.llm import id_files, packing
from tidemark.llm.tokens import TextEncoder, tokenizer_path


@pytest.fixture(scope="module")
def tool():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def encoder():
    return TextEncoder(tokenizer_path())


def ids_of(tool, text, end):
    return [*tool.encode(text or "", add_special_tokens=False).ids, end]


@pytest.mark.parametrize(
    "text",
    [
        "É À Übung ÇA. İstanbul", "<|endoftext|> hi", "J̌ x", "it's I'LL we've ''s", "ª º µ Straße",
        "a b\u0085c\x1cd", "12,345.67 x2y", "naïve,café. don't,stop.", "!!!,,,...", "日本語", "é É",
    ],
)
def test_encoder_equals_the_library(tool, encoder, text):
    assert encoder(text) == np.array(ids_of(tool, text, 0)[:-1], "<u4").tobytes()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_encoder_equals_the_library_on_any_text(tool, encoder, text):
    assert encoder(text) == np.array(ids_of(tool, text, 0)[:-1], "<u4").tobytes()


@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_codes_round_trip(values):
    control, data = id_files.encode(np.array(values, np.uint32))
    assert id_files.decode(control, data, len(values)).tolist() == values
    assert len(control) == -(-len(values) // 4)


@pytest.mark.parametrize("block", [id_files.BLOCK, 5])
def test_files_hold_all_ids_in_order(spark, tool, monkeypatch, block):
    monkeypatch.setattr(id_files, "BLOCK", block)
    docs = odd_docs(spark, [(k, f"text {k} of a row") for k in (90, 20, 55)]).repartition(4)
    rows = sorted(
        ((r.doc_id, ids_of(tool, r.text, 2)) for r in docs.collect()),
        key=lambda r: (r[0] is None, r[0] or 0, len(r[1])),
    )
    expected, at = [], 0
    for doc, ids in rows:
        expected.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    found = sorted(map(tuple, id_files.round_trip(docs).collect()), key=lambda r: r[1])
    assert found == expected and found[-1][0] is None
    assert id_files.round_trip(no_docs(spark)).count() == 0


def test_packing_places_every_piece_once(spark, tool):
    docs = odd_docs(spark, [(k, "some words " * (k % 40)) for k in range(10, 200)])
    packed = packing.pack(docs, size=64, shard_docs=60)
    found = packed.toPandas()
    expected = []
    for r in docs.collect():
        ids = ids_of(tool, r.text, 1)
        for k in range(0, len(ids), 64):
            piece = np.array(ids[k : k + 64], "<u4")
            expected.append((r.doc_id, k // 64, k, len(piece), zlib.crc32(piece.tobytes())))
    got = packed.select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    for _, rows in found.sort_values("offset").groupby("sequence_id"):
        assert rows["offset"].tolist() == [0, *rows["length"].cumsum().tolist()[:-1]]
        assert rows["length"].sum() <= 64
    assert packing.pack(no_docs(spark)).count() == 0


def test_two_for_one_fills_a_gap():
    # Greedy leaves 60 + 30 with a gap of ten; 22 and 18 instead of 30 leave none.
    bins = packing.fill(np.array([60, 30, 22, 18]), 100)
    assert sorted(map(sorted, bins)) == [[18, 22, 60], [30]]
    lengths = np.random.default_rng(0).integers(1, 900, 3000)
    bins = packing.fill(lengths, 1000)
    assert sorted(x for b in bins for x in b) == sorted(lengths)
    assert len(bins) <= 1.02 * lengths.sum() / 1000 + 1
