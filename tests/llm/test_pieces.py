"""Piece ids and decoded texts against the sentencepiece library."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import piece_codec, queries
from tessera.llm.tokens import tokenizer_path
from tests.llm.odd_tables import none, odd

PATH = tokenizer_path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
PARTS = st.sampled_from(
    ["the", "The", " ", "  ", "   ", "\n", "\t", "thing,", "ing", "'s", "12", "...", "é", "İ", "ß", "日本", "語", "🙂", "𝒳", "́", "\x00",
     "▁", "▁▁", "<s>", "</s>", "<0x41>", "<unk>", "a", "-", "_", "====", "un", "re", "tion", " ", "�", "qqqq", "zx"]
)
TEXTS = st.one_of(st.lists(PARTS, max_size=20).map("".join), st.text(st.characters(exclude_categories=["Cs"]), max_size=40))


def coded(texts):
    c = piece_codec.codec(PATH)
    sizes, ids = c.encode(texts)
    ends = np.cumsum(sizes)
    return [ids[e - n : e].tolist() for e, n in zip(ends, sizes)], c.decode(sizes, ids)


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=5))
def test_ids_and_texts_are_those_of_the_library(texts):
    ids, decoded = coded(texts)
    assert ids == [LIBRARY.encode(t, add_bos=True, add_eos=True) for t in texts]
    assert decoded == [LIBRARY.decode(i) for i in ids]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 31999), st.integers(0, 262), st.just(28705)), max_size=15), min_size=1, max_size=4))
def test_any_ids_decode_as_in_the_library(rows):
    got = piece_codec.codec(PATH).decode(np.array([len(r) for r in rows]), np.array(sum(rows, []), np.uint32))
    assert got == [LIBRARY.decode(r) for r in rows]


def test_long_stretches_without_blanks():
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdeéx日1.=") for _ in range(20_000)), "a" * 5000, " " * 3001 + "x" + " " * 40, "▁" * 333]
    ids, decoded = coded(texts)
    assert ids == [LIBRARY.encode(t, add_bos=True, add_eos=True) for t in texts]
    assert decoded == [LIBRARY.decode(i) for i in ids]


def test_table_gives_what_merging_gives_for_every_prefix():
    c = piece_codec.codec(PATH)
    letters = "▁unbelievably▁▁reread▁tionsing,,==▁qqé"
    last = c.prefix_table(letters)
    for end in range(1, len(letters) + 1):
        assert c.merges.merged(letters[:end])[0][-1] == last[end]
    assert c.pieces(letters) == c.merges.merged(letters)[0]


def test_neighbours_are_pairs_that_merging_leaves():
    c = piece_codec.codec(PATH)
    rng = random.Random(1)
    own = [p for p in c.ids if c.merges.merged(p)[0] == [p]]
    for _ in range(20_000):
        a, b = rng.choice(own), rng.choice(own)
        assert c.merges.neighbours(a, b) == (c.merges.merged(a + b)[0] == [a, b]), (a, b)


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(open(PATH, "rb").read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "m").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="merge-type"):
        piece_codec.Codec(str(tmp_path / "m"))


def test_query_against_the_library(spark):
    folder = "/root/testdata/sf0.01"
    expected = set()
    for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        ids = LIBRARY.encode(r.text or "", add_bos=True, add_eos=True)
        text = LIBRARY.decode(ids)
        expected.add((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    df = queries.QUERIES["op12_prefix_table"](spark, folder)
    assert dict(df.dtypes) == {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(expected) and set(rows) == expected


def test_odd_rows(spark):
    df = odd(spark).withColumnRenamed("kept", "ids")
    rows = piece_codec.decode(piece_codec.encode(df, PATH), PATH).collect()
    texts = [r.text for r in df.collect()]
    assert [(r.doc_id, list(np.frombuffer(r.ids, "<u4"))) for r in rows] == [
        (r.doc_id, LIBRARY.encode(r.text or "", add_bos=True, add_eos=True)) for r in df.collect()
    ]
    assert [r.decoded for r in rows] == [LIBRARY.decode(LIBRARY.encode(t or "")) for t in texts]
    assert [r.n_words for r in rows] == [r.n_words for r in df.collect()]
    assert piece_codec.decode(piece_codec.encode(none(spark), PATH), PATH).collect() == []
    nulls = spark.createDataFrame([(None,), (b"",)], "ids binary")
    assert [r.decoded for r in piece_codec.decode(nulls, PATH).collect()] == [None, ""]
