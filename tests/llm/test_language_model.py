"""The attention model: gradients, masks, held-out gain; base scores against plain arithmetic."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import lm_score as lm
from tessera.llm.tokens import tokenizer_path
from tests.llm.odd_tables import none, odd

TOKENIZER = tokenizer_path("word_bpe_49k.json")


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


@pytest.mark.parametrize("rows", [None, "small"])
def test_base_scores(spark, small, rows, monkeypatch):
    monkeypatch.setattr(lm, "STEPS", 5)
    monkeypatch.setattr(lm, "TOP_WORDS", 50)
    docs = odd(spark) if rows is None else spark.read.parquet(f"{small}/documents.parquet")
    held = {r.doc_id: zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 10 == 0 for r in docs.collect()}
    counts, ends = Counter(), 0
    for r in docs.collect():
        if not held[r.doc_id]:
            counts.update(plain_words(r.text))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    counts[None] = ends
    texts = {r.doc_id: [*plain_words(r.text), None] for r in docs.collect()}
    got = lm.score(docs, TOKENIZER).collect()
    assert len(got) == docs.count()
    for r in got:
        w = texts[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(w), sum(counts[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), rel=1e-9)
        assert r.score < 0


def test_empty_table(spark):
    assert lm.score(none(spark), TOKENIZER).count() == 0


def small_model(seed=1):
    g = np.random.Generator(np.random.PCG64(seed))
    counts = np.append(g.integers(0, 50, 29).astype(float), 0)
    classes, share, slot = lm.classify(counts, 6)
    weights = lm.start_weights(lm.OWN_EMBEDDINGS + 7, 6, np.bincount(classes, counts, 6) / counts.sum())
    return lm.Model(classes, share, slot, weights), g


def test_shares_sum_to_one():
    model, _ = small_model()
    assert sum(math.exp(s) for s in model.log_share[:-1]) == pytest.approx(len(set(model.classes[:-1])))


def test_windows_score_every_id_once():
    lengths, ids = np.array([0, 5, 23, 24, 100]), np.arange(152) % 28
    inputs, targets, doc = lm.windows(lengths, ids, 28, 29)
    ends = np.cumsum(lengths)
    for i, n in enumerate(lengths):
        mine = targets[doc == i]
        assert mine[mine != 29].tolist() == [*ids[ends[i] - n : ends[i]], 28]
    assert inputs.shape[1] == lm.CONTEXT and targets.shape[1] == lm.STRIDE


def test_gradients_agree_with_differences():
    model, g = small_model()
    w = {k: v.astype(np.float64) for k, v in model.weights.items()}
    inputs, targets, _ = lm.windows(np.array([30, 7]), g.integers(0, 28, 37), model.end, model.pad)
    args = model.slot[inputs], inputs == model.pad, model.classes[targets], targets != model.pad
    _, grads = lm.gradients(w, *args)
    for name in ("query", "key", "value", "out", "bias", "places"):
        at = tuple(int(g.integers(0, n)) for n in w[name].shape)
        changed = {k: v.copy() for k, v in w.items()}
        changed[name][at] += 1e-5
        up, _ = lm.gradients(changed, *args)
        changed[name][at] -= 2e-5
        down, _ = lm.gradients(changed, *args)
        assert grads[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-5)


def test_scorer_is_causal_and_equals_the_forward_pass():
    model, g = small_model()
    ids = g.integers(0, 28, 60)
    score = lm.Scorer(model).score
    whole = score(np.array([60]), ids)[0]
    inputs, targets, _ = lm.windows(np.array([60]), ids, model.end, model.pad)
    z = lm.forward(model.weights, model.slot[inputs], inputs == model.pad)[0].astype(float)
    z -= np.log(np.exp(z).sum(2, keepdims=True))
    real = targets != model.pad
    b, s = np.nonzero(real)
    assert whole == pytest.approx((z[b, s, model.classes[targets[real]]] + model.log_share[targets[real]]).sum(), rel=1e-4)
    several = score(np.array([60, 0, 60]), np.concatenate([ids, ids]), at_once=2)
    assert several[0] == pytest.approx(whole, rel=1e-5) and several[2] == pytest.approx(whole, rel=1e-5)
    changed = ids.copy()
    changed[-1] = (changed[-1] + 1) % 28
    first = [score(np.array([59]), x[:59])[0] for x in (ids, changed)]
    assert first[0] == first[1]


def test_context_beats_counts_on_held_out_text():
    g = np.random.Generator(np.random.PCG64(2))
    follow = g.permutation(28)

    def text(n):
        out = [int(g.integers(0, 28))]
        while len(out) < n:
            out.append(int(follow[out[-1]]) if g.random() < 0.8 else int(g.integers(0, 28)))
        return np.array(out)

    ids = text(20_000)
    counts = np.append(np.bincount(ids, minlength=28).astype(float), [50, 0])
    classes, share, slot = lm.classify(counts, 29)
    model = lm.Model(classes, share, slot, lm.start_weights(lm.OWN_EMBEDDINGS + 30, 29, np.full(29, 1 / 29)))
    inputs, targets, _ = lm.windows(np.full(200, 100), ids, model.end, model.pad)
    losses = lm.fit(model, inputs, targets, 300)
    held = text(2_000)
    ours = lm.Scorer(model).score(np.array([2_000]), held)[0]
    by_counts = np.log(counts[held] / counts.sum()).sum()
    assert losses[-1] < losses[0] and ours > 0.7 * by_counts


def test_training_sees_every_window_of_every_document(spark, monkeypatch):
    monkeypatch.setattr(lm, "BATCH", 8)
    r = np.random.Generator(np.random.PCG64(5))
    follow = r.permutation(20)

    def text(n):
        at, out = 0, []
        for _ in range(n):
            at = int(follow[at]) if r.random() < 0.9 else int(r.integers(0, 20))
            out.append("abcdefghijklmnopqrst"[at])
        return " ".join(out)

    rows = [(i, text(60)) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("train", lm.F.lit(True))
    enc = lm.encoder(TOKENIZER, True)
    lengths, ids = lm.word_ids(enc, pa.array([t for _, t in rows]))
    counts = np.append(np.bincount(ids, minlength=enc.size), [1000, 0]).astype(float)
    classes, share, slot = lm.classify(counts)
    smooth = np.bincount(classes, np.append(counts[:-1] + 0.1, 0), lm.CLASSES)
    weights = lm.start_weights(lm.OWN_EMBEDDINGS + lm.CLASSES + 1, lm.CLASSES, smooth / smooth.sum())
    model = lm.Model(classes, share, slot, weights)
    before = lm.Scorer(model).score(lengths[:50], ids[: lengths[:50].sum()]).sum()
    n = len(lm.windows(lengths, ids, model.end, model.pad)[0])
    seen = lm.fit_all(docs.select("doc_id", "text"), model, TOKENIZER, n)
    assert sum(seen) == len(lm.windows(lengths, ids, model.end, model.pad)[0]) and min(seen) > 0
    after = lm.Scorer(model).score(lengths[:50], ids[: lengths[:50].sum()]).sum()
    assert after > 0.8 * before
    twice = lm.Model(classes, share, slot, lm.start_weights(lm.OWN_EMBEDDINGS + lm.CLASSES + 1, lm.CLASSES, smooth / smooth.sum()))
    lm.fit_all(docs.select("doc_id", "text"), twice, TOKENIZER, n)
    assert all((model.weights[k] == twice.weights[k]).all() for k in model.weights)


def test_what_is_learnt_does_not_depend_on_partitions_and_helps(spark):
    """The documents of sf0.01 in 1, 4 and 32 partitions and several shards: one model, better than counts on held-out texts."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", (~lm.held_out()).alias("train"))
    held = [r.text for r in docs.where("NOT train").collect()]
    counts = lm.word_counts(docs.where("train"))
    n_train = docs.where("train").count()
    models = [lm.train(docs.repartition(n), counts, n_train, TOKENIZER) for n in (1, 4, 32)]
    for other in models[1:]:
        assert all((models[0].weights[k] == other.weights[k]).all() for k in other.weights)
    model = models[0]
    lengths, ids = lm.word_ids(lm.encoder(TOKENIZER, True), pa.array(held))
    ours = lm.Scorer(model).score(lengths, ids).sum()
    smooth = np.zeros(len(model.classes) - 1)
    for i, n in lm.id_counts(counts, TOKENIZER).items():
        smooth[i] = n
    smooth[model.end] = n_train
    smooth += 0.1
    by_counts = np.log(smooth / smooth.sum())
    plain = by_counts[ids].sum() + len(held) * by_counts[model.end]
    assert (ours - plain) / (len(ids) + len(held)) > 0.5


def test_shards_follow_windows(spark, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_WINDOWS", 2)
    docs = spark.range(200).selectExpr("id AS doc_id", "concat('word', id % 7, ' other text ', id) AS text")
    dealt = {n: sorted(map(tuple, lm.deal(docs.repartition(n), TOKENIZER, 5).collect())) for n in (1, 7)}
    assert dealt[1] == dealt[7] and {r[0] for r in dealt[1]} == set(range(5)) and {r[3] for r in dealt[1]} == set(range(lm.ROUNDS))


def test_gradients_of_many_windows_are_those_of_their_parts():
    """More windows than are worked on side by side, in arrays that are used again, against a few windows at a time."""
    model, g = small_model()
    w = {k: v.astype(np.float64) for k, v in model.weights.items()}
    inputs, targets, _ = lm.windows(np.array([700, 3, 0, 1500, 40]), g.integers(0, 28, 2243), model.end, model.pad)
    args = model.slot[inputs], inputs == model.pad, model.classes[targets], targets != model.pad
    room = lm.Room()
    loss, whole = lm.gradients(w, *args, room)
    sums = {k: 0.0 for k in w}
    loss_sum, n_real = 0.0, args[3].sum()
    for i in range(0, len(inputs), 11):
        part = [a[i : i + 11] for a in args]
        some_loss, some = lm.gradients(w, *part, room)
        rows = np.zeros_like(w["tokens"])
        rows[some["tokens"][0]] = some["tokens"][1]
        for k in w:
            sums[k] += (rows if k == "tokens" else some[k]) * part[3].sum() / n_real
        loss_sum += some_loss * part[3].sum() / n_real
    rows = np.zeros_like(w["tokens"])
    rows[whole["tokens"][0]] = whole["tokens"][1]
    assert len(inputs) > lm._NEAR and loss == pytest.approx(loss_sum)
    for k in w:
        assert rows == pytest.approx(sums[k], abs=1e-12) if k == "tokens" else whole[k] == pytest.approx(sums[k], abs=1e-12)


def test_texts_are_encoded_once(spark, monkeypatch):
    """The written ids are those of the texts, and what is learnt and scored follows them, not a second encoding."""
    monkeypatch.setattr(lm, "STEPS", 5)
    docs = odd(spark).withColumn("train", ~lm.held_out())
    coded = lm.code(docs, TOKENIZER).collect()
    enc = lm.encoder(TOKENIZER, True)
    assert len(coded) == docs.count()
    for r in coded:
        assert np.frombuffer(r.ids, "<u2").tolist() == lm.word_ids(enc, pa.array([r.text], pa.string()))[1].tolist()
    counts = lm.word_counts(docs)
    assert lm.id_counts(counts, TOKENIZER) == lm.id_counts(lm.code(docs, TOKENIZER).where("train"), TOKENIZER)
    code = lm.code
    monkeypatch.setattr(lm, "code", lambda rows, path: code(rows, path).withColumn("ids", lm.F.lit(bytearray())))
    got = lm.score(docs.drop("train"), TOKENIZER).collect()
    assert len({r.n_tokens for r in got}) > 1 and len({r.score for r in got}) == 1
