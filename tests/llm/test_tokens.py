"""Token ids against whole-text calls, exact round trips of files, packing rules."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import packing, token_files
from tessera.llm.tokens import encoder, tokenizer_path
from tessera.session import scratch
from tests.llm.odd_tables import none, odd

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"


def whole(name, texts):
    return [e.ids for e in encoder(tokenizer_path(name), name == WORD).tokenizer.encode_batch(texts, add_special_tokens=False)]


PIECES = st.sampled_from(
    ["the", "The", " ", "  ", "\n", "\t", "thing,", "it's", "'S", "12", "...", "é", "É", "İ", "ß", "日本", "🙂", "́", "\x01",
     "<|endoftext|>", " ", "Σ", "a", "-", "_"]
)


@pytest.mark.parametrize("name", [BYTE, WORD])
@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=15).map("".join), min_size=1, max_size=6))
def test_pieces_give_the_ids_of_the_whole_text(name, texts):
    lengths, ids = encoder(tokenizer_path(name), name == WORD).encode(pa.array([*texts, None])[: len(texts)])
    ends = np.cumsum(lengths)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, lengths)] == whole(name, texts)


@pytest.mark.parametrize("name", [BYTE, WORD])
def test_special_tokens_in_text_give_the_ids_of_a_fresh_tokenizer(name):
    fresh = Tokenizer.from_file(tokenizer_path(name))
    texts = ["foo <|endoftext|> bar", "a<|startoftext|>b c", "<|ENDOFTEXT|> x", "<|endoftext|>", "plain words", " <|endoftext|> <|endoftext|>"]
    lengths, ids = encoder(tokenizer_path(name), name == WORD).encode(pa.array(texts))
    ends = np.cumsum(lengths)
    got = [ids[e - n : e].tolist() for e, n in zip(ends, lengths)]
    assert got == [fresh.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(got[0]) <= 4


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.integers(1, 70))
def test_planes_round_trip(ids, block):
    ids = np.array(ids, np.uint32)
    sizes, data = token_files.pack_planes(ids, block)
    assert len(sizes) == 4 * -(-len(ids) // block)
    assert token_files.unpack_planes(len(ids), sizes, data, block).tolist() == ids.tolist()


def test_files_hold_all_documents_in_order(spark, monkeypatch):
    monkeypatch.setattr(token_files, "CHUNK", 64)
    docs = odd(spark).repartition(3)
    path = scratch(spark, "test-planes")
    token_files.write(docs, path, tokenizer_path(BYTE), end=2)
    rows = sorted(token_files.read(spark, path).collect(), key=lambda r: r.start)
    key = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert key == sorted(key) and len(rows) == docs.count()
    texts = {(r.doc_id): r.text or "" for r in docs.collect()}
    at = 0
    for r in rows:
        ids = [*whole(BYTE, [texts[r.doc_id]])[0], 2]
        assert (r.start, r.n_tokens) == (at, len(ids)) and np.frombuffer(r.ids, "<u4").tolist() == ids
        at += len(ids)


def test_empty_table_gives_empty_files(spark):
    path = scratch(spark, "test-planes")
    token_files.write(none(spark), path, tokenizer_path(BYTE), end=2)
    assert token_files.read(spark, path).count() == 0


def plain_first_fit(lengths, room):
    rooms, bins = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        b = next((b for b, r in enumerate(rooms) if r >= lengths[i]), None)
        if b is None:
            rooms.append(room)
            b = len(rooms) - 1
        rooms[b] -= lengths[i]
        bins[i] = b
    return [bins[i] for i in range(len(lengths))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_tree_finds_the_first_fit(lengths):
    bins, offsets = packing.first_fit_decreasing(np.array(lengths, np.int64), 20)
    assert bins.tolist() == plain_first_fit(lengths, 20)
    assert all(0 <= o and o + n <= 20 for o, n in zip(offsets.tolist(), lengths))


@pytest.mark.parametrize("group", [2, 8192])
def test_every_id_lies_in_one_piece(spark, group):
    docs = odd(spark)
    rows = packing.pack(docs, tokenizer_path(WORD), end=1, length=64, group=group).collect()
    sequences, spans = defaultdict(list), defaultdict(int)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    encoded = {d: [*whole(WORD, [t])[0], 1] for d, t in texts.items()}
    for r in rows:
        ids = encoded[r.doc_id]
        part = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
        assert r.doc_tokens == len(ids) and zlib.crc32(part) == r.ids_crc32 and len(part) == 4 * r.length
        sequences[r.sequence_id].append((r.offset, r.length))
        spans[r.doc_id, r.start] += 1
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    copies = defaultdict(int)
    for r in docs.collect():
        copies[r.doc_id] += 1
    assert all(n == copies[doc] for (doc, _), n in spans.items())
    assert packing.pack(none(spark), tokenizer_path(WORD), end=1).count() == 0


def test_packing_leaves_little_room(spark, small):
    rows = packing.pack(spark.read.parquet(f"{small}/documents.parquet"), tokenizer_path(WORD), end=1).collect()
    held = sum(r.length for r in rows)
    assert held / (2048 * len({r.sequence_id for r in rows})) > 0.97
