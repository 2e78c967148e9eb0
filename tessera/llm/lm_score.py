"""Language-model scores: a causal self-attention model in numpy over subword ids.

Gathered from the whole training part of the corpus, as tables that grow with it: the count of every word,
from which the base score comes, and from those the count of every subword id. The ids are put into
classes of about equal mass, frequent ids into classes of their own. The probability of an id is the
model's probability of its class in context times the id's smoothed share of its class by the counts.

Every text is encoded once; training and scoring read the written ids.

The attention model that predicts classes has one head: token and place embeddings, queries, keys and
values, and an output layer over the token and what it attends to. It is trained by Adam with gradients
written out below, on all windows of all training documents. A hash deals the documents to ``ROUNDS`` rounds and
within a round to shards of some ``SHARD_WINDOWS`` windows. In a round every shard
starts from the same weights and takes steps over its own windows; the weights, averaged by windows seen,
begin the next round. Shards follow the number of windows, not files or tasks, so what is learnt does not depend
on how the table lies. Only arrays of the size of the weights leave the tasks; their sums are of whole numbers,
so the order of tasks makes no difference. Steps grow with the input; a corpus too small for ``STEPS`` steps is
gone through several times. Scoring takes whole texts: windows of 32 ids overlap by eight, the last 24 of each are scored, so every id is scored once with
8 to 31 ids before it, in batches with a causal mask.

Words of the broadcast list, the most frequent ones up to ``TOP_WORDS``, are counted in the scoring task;
all others go through a join with the count table, so the base score is exact for every text.

Null text is empty and is one end token. The training part is told by the crc32 of the id as text; a null
id counts as the empty text and is held out. Repeated rows are scored alike; each counts in training.
Without any training document every count is zero and the model falls back to equal shares.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import prod

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import _offsets, extended, own_texts, ragged, slices, written
from tessera.llm.tokens import encoder

CLASSES = 64
#: Ids with an embedding of their own; the others share one per class.
OWN_EMBEDDINGS = 4096
WIDTH = 16
CONTEXT, STRIDE = 32, 24
OVERLAP = CONTEXT - STRIDE
#: Least number of training steps, windows in a step, rounds between which weights are averaged.
STEPS, BATCH, ROUNDS = 400, 256, 6
RATE = 0.01
#: Windows that a shard of a round has on average, and ids that are gathered before steps over their windows.
SHARD_WINDOWS, GATHERED = 50_000, 400_000
#: Words whose counts are sent to all tasks, at most.
TOP_WORDS = 200_000


def held_out(id_column: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 10 == 0


def word_codes(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the code of every word, and where each text's codes begin (and the last ends)."""
    texts = pc.ascii_lower(own_texts(texts))
    for gap in "\t\n\v\f\r":
        texts = pc.replace_substring(texts, gap, " ")
    split = pc.split_pattern(texts, " ")
    bounds = _offsets(split).astype(np.int64)
    coded = split.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
    bounds -= bounds[0]
    codes, words = coded.indices.to_numpy(), coded.dictionary
    empty = pc.index(words, pa.scalar("", words.type)).as_py()
    if empty >= 0:
        real = codes != empty
        bounds = np.concatenate([[0], np.cumsum(real)])[bounds]
        codes = codes[real]
    return words, codes.astype(np.int64), bounds


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n over all rows with ``train``; tasks sum the words they met often before they pass them on."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sums = pa.array([], pa.large_string()), np.empty(0, np.int64)

        def rows(words: pa.Array, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([words.cast(pa.string()), pa.array(n)], names=["word", "n"])

        for batch in slices(batches, "text"):
            words, codes, bounds = word_codes(batch.column("text"))
            train = batch.column("train").to_numpy(zero_copy_only=False)
            n = np.bincount(codes[np.repeat(train, np.diff(bounds))], minlength=len(words))
            at = pc.index_in(words, value_set=known).fill_null(-1).to_numpy()
            sums += np.bincount(at[at >= 0], n[at >= 0], len(sums)).astype(np.int64)
            rest = np.flatnonzero((at < 0) & (n > 0))
            room = 200_000 - len(known)
            often = rest[n[rest] > 1][: max(0, room)]
            known = pa.concat_arrays([known, words.take(pa.array(often))])
            sums = np.concatenate([sums, n[often]])
            rest = np.setdiff1d(rest, often, assume_unique=True)
            if len(rest):
                yield rows(words.take(pa.array(rest)), n[rest])
        if len(known):
            yield rows(known, sums)

    parts = docs.select("text", "train").mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def id_counts(counts: DataFrame, tokenizer: str) -> dict[int, int]:
    """Count of every subword id, from the counts of words (word, n) or the ids of texts (ids); at most the vocabulary reaches the driver."""
    coded = "ids" in counts.columns

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, True)
        total = np.zeros(enc.size, np.int64)
        if coded:
            for batch in batches:
                total += np.bincount(coded_ids(batch.column("ids"), enc)[1], minlength=enc.size)
        else:
            for batch in slices(batches, "word", 1 << 20):
                lengths, ids = enc.encode_pieces(batch.column("word").to_pylist())
                total += np.bincount(ids, np.repeat(batch.column("n").to_numpy(), lengths), enc.size).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])

    wanted = counts.select("ids") if coded else counts
    rows = wanted.mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    return {r["id"]: r["n"] for r in rows}


@dataclass
class Model:
    """Classes and shares of ids, and the weights of the attention model. Ids: vocabulary, end, pad."""

    classes: np.ndarray  # id -> class
    log_share: np.ndarray  # id -> natural log of its share of the class
    slot: np.ndarray  # id -> embedding
    weights: dict[str, np.ndarray]

    @property
    def end(self) -> int:
        return len(self.classes) - 2

    @property
    def pad(self) -> int:
        return len(self.classes) - 1


def classify(counts: np.ndarray, n_classes: int = CLASSES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class, log share and embedding slot of every id, by counts; the last id is the pad and has no share."""
    smooth = counts + 0.1
    smooth[-1] = 0
    order = np.argsort(-smooth, kind="stable")
    classes = np.empty(len(counts), np.int64)
    left, room, now = smooth.sum(), n_classes, 0
    held = 0.0
    goal = left / room
    for i in order.tolist():
        classes[i] = now
        held += smooth[i]
        if held >= goal and now < n_classes - 1:
            left, room, now, held = left - held, room - 1, now + 1, 0.0
            goal = left / room
    totals = np.bincount(classes, smooth, n_classes)
    with np.errstate(divide="ignore"):
        share = np.log(smooth / totals[classes])
    slot = np.where(np.argsort(order) < OWN_EMBEDDINGS, np.argsort(order), OWN_EMBEDDINGS + classes)
    slot[-1] = OWN_EMBEDDINGS + n_classes
    return classes, share, slot


def windows(lengths: np.ndarray, ids: np.ndarray, end: int, pad: int) -> tuple[np.ndarray, ...]:
    """Input ids of each window, target ids of its last STRIDE places (pad beyond the text), its document.

    A document's inputs are the end id, as begin, and its ids; its targets are its ids and the end id.
    """
    n = lengths + 1
    count = -(-n // STRIDE)
    stream = np.insert(ids.astype(np.int32), np.cumsum(lengths) - lengths, end)  # begin and ids of each document
    starts = np.cumsum(n) - n
    doc = np.repeat(np.arange(len(n)), count)
    first = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * STRIDE
    place = first[:, None] + np.arange(-OVERLAP, STRIDE)
    inside = (place >= 0) & (place < n[doc][:, None])
    inputs = np.where(inside, stream[np.where(inside, starts[doc][:, None] + place, 0)], pad)
    place = place[:, OVERLAP:] + 1
    targets = np.full(place.shape, pad, np.int32)
    more = place < n[doc][:, None]
    targets[more] = stream[(starts[doc][:, None] + place)[more]]
    targets[place == n[doc][:, None]] = end
    return inputs, targets, doc


_CAUSAL = (np.arange(CONTEXT) <= np.arange(OVERLAP, CONTEXT)[:, None]).astype(np.float32)


def start_weights(n_slots: int, n_classes: int, class_share: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    g = np.random.Generator(np.random.PCG64(seed))

    def small(*shape: int) -> np.ndarray:
        return (g.standard_normal(shape) * 0.1).astype(np.float32)

    return {
        "tokens": small(n_slots, WIDTH), "places": small(CONTEXT, WIDTH),
        "query": small(WIDTH, WIDTH), "key": small(WIDTH, WIDTH), "value": small(WIDTH, WIDTH),
        "out": small(2 * WIDTH, n_classes), "bias": np.log(class_share + 1e-6).astype(np.float32),
    }


def forward(w: dict[str, np.ndarray], slots: np.ndarray, padded: np.ndarray) -> tuple[np.ndarray, ...]:
    """Class logits of the last STRIDE places, with what the gradients need."""
    x = w["tokens"][slots] + w["places"]
    q = x[:, OVERLAP:] @ (w["query"] / np.float32(np.sqrt(WIDTH)))
    k, v = x @ w["key"], x @ w["value"]
    a = np.exp(np.minimum(q @ k.transpose(0, 2, 1), 30)) * _CAUSAL
    a *= ~padded[:, None, :]
    a /= a.sum(2, keepdims=True) + np.float32(1e-9)
    h = np.concatenate([x[:, OVERLAP:], a @ v], 2)
    return h @ w["out"] + w["bias"], h, a, q, k, v, x


class Room:
    """Arrays that one step after the other works in, by name, as fresh ones cost more than what is done in them."""

    def __init__(self) -> None:
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, shape: tuple[int, ...], kind: np.dtype) -> np.ndarray:
        size = prod(shape)
        found = self.held.get(name)
        if found is None or len(found) < size or found.dtype != kind:
            found = self.held[name] = np.empty(size, kind)
        return found[:size].reshape(shape)


def _stacked(a: np.ndarray) -> np.ndarray:
    """The rows of all windows in stacks of eight windows, or one: products of small matrices are the fast ones."""
    return a.reshape(len(a) if len(a) % 8 else len(a) // 8, -1, a.shape[-1])


def _projections(w: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Query, key and value side by side, queries divided by the root of the width; the output layer over its bias."""
    root = w["query"].dtype.type(np.sqrt(WIDTH))
    return np.concatenate([w["query"] / root, w["key"], w["value"]], 1), np.concatenate([w["out"], w["bias"][None]])


def _attended(tokens: np.ndarray, places: np.ndarray, qkv: np.ndarray, slots: np.ndarray, first: np.ndarray, room: Room):
    """Token rows, their queries, keys and values, attention, and what the output layer sees (with a one), by window.

    ``first`` tells the windows that begin a document, whose first OVERLAP places are pads. Pads behind a document are
    seen by places behind it only, which have no target.
    """
    m, kind = len(slots), tokens.dtype
    x = np.take(tokens, slots, axis=0, out=room("x", (m, CONTEXT, WIDTH), kind), mode="clip")
    x += places
    all_three = room("qkv", (m, CONTEXT, 3 * WIDTH), kind)
    np.matmul(_stacked(x), qkv, out=_stacked(all_three))
    q, k, v = all_three[:, OVERLAP:, :WIDTH], all_three[:, :, WIDTH : 2 * WIDTH], all_three[:, :, 2 * WIDTH :]
    turned = room("keys", (m, WIDTH, CONTEXT), kind)
    np.copyto(turned, k.transpose(0, 2, 1))
    a = np.matmul(q, turned, out=room("attention", (m, STRIDE, CONTEXT), kind))
    if a.max() > 30:
        np.minimum(a, 30, out=a)
    np.exp(a, out=a)
    a *= _CAUSAL
    a[first, :, :OVERLAP] = 0
    sums = a.reshape(-1, CONTEXT) @ np.ones(CONTEXT, kind)
    sums += kind.type(1e-9)
    a *= np.reciprocal(sums, out=sums).reshape(m, STRIDE, 1)
    h = room("h", (m, STRIDE, 2 * WIDTH + 1), kind)
    h[:, :, :WIDTH] = x[:, OVERLAP:]
    np.matmul(a, v, out=h[:, :, WIDTH : 2 * WIDTH])
    h[:, :, 2 * WIDTH] = 1
    return x, q, k, v, a, h


def _logits(h: np.ndarray, out: np.ndarray, room: Room) -> np.ndarray:
    z = room("z", (len(h), STRIDE, out.shape[1]), h.dtype)
    np.matmul(_stacked(h), out, out=_stacked(z))
    if z.max() > 80:
        np.minimum(z, 80, out=z)
    return z


#: Windows worked on side by side, so that what a step works in stays near the core.
_NEAR = 64


def gradients(
    w: dict[str, np.ndarray], slots: np.ndarray, padded: np.ndarray, classes: np.ndarray, real: np.ndarray,
    room: Room | None = None, with_loss: bool = True,
):
    """Mean loss over real targets and its gradient by every weight; for ``tokens`` the rows met and their gradients."""
    room = room or Room()
    n, kind, n_classes = len(slots), w["tokens"].dtype, w["out"].shape[1]
    qkv, out = _projections(w)
    qkv_back, out_back = np.ascontiguousarray(qkv.T), np.ascontiguousarray(w["out"].T)
    n_real = max(1, np.count_nonzero(real))
    dx = room("dx", (n, CONTEXT, WIDTH), kind)
    d_qkv, d_out, loss = np.zeros(qkv.shape, kind), np.zeros(out.shape, kind), 0.0
    for begin in range(0, n, _NEAR):
        some = slice(begin, min(n, begin + _NEAR))
        x, q, k, v, a, h = _attended(w["tokens"], w["places"], qkv, slots[some], padded[some, 0], room)
        m = len(x)
        p = _logits(h, out, room)
        np.exp(p, out=p)
        sums = p.reshape(-1, n_classes) @ np.ones(n_classes, kind)
        counted, flat = real[some].ravel(), p.reshape(-1)
        target = classes[some].ravel() + np.arange(0, m * STRIDE * n_classes, n_classes)
        if with_loss:
            loss -= float(np.log(flat[target][counted] / sums[counted] + 1e-9).sum())
        # Targets beyond a document weigh nothing.
        share = counted * kind.type(1 / n_real)
        p *= (share / sums).reshape(m, STRIDE, 1)
        flat[target] -= share
        d_out += np.matmul(_stacked(h).transpose(0, 2, 1), _stacked(p)).sum(0)
        dh = room("dh", (m, STRIDE, 2 * WIDTH), kind)
        np.matmul(_stacked(p), out_back, out=_stacked(dh))
        d_mixed = dh[:, :, WIDTH:]
        turned = room("keys", (m, WIDTH, CONTEXT), kind)
        np.copyto(turned, v.transpose(0, 2, 1))
        ds = np.matmul(d_mixed, turned, out=room("ds", (m, STRIDE, CONTEXT), kind))
        # The mean of a row of ds under its attention is the gradient times what was mixed.
        ds -= np.einsum("bij,bij->bi", d_mixed, h[:, :, WIDTH : 2 * WIDTH])[:, :, None]
        ds *= a
        d = room("d", (m, CONTEXT, 3 * WIDTH), kind)
        d[:, :OVERLAP, :WIDTH] = 0
        np.matmul(ds, k, out=d[:, OVERLAP:, :WIDTH])
        np.matmul(ds.transpose(0, 2, 1), q, out=d[:, :, WIDTH : 2 * WIDTH])
        np.matmul(a.transpose(0, 2, 1), d_mixed, out=d[:, :, 2 * WIDTH :])
        np.matmul(_stacked(d), qkv_back, out=_stacked(dx[some]))
        dx[some, OVERLAP:] += dh[:, :, :WIDTH]
        d_qkv += np.matmul(_stacked(x).transpose(0, 2, 1), _stacked(d)).sum(0)
    # Rows of one slot side by side, so that they are added in one sweep.
    order = np.argsort(slots.ravel().astype(np.uint16), kind="stable")
    met = slots.ravel()[order]
    first = np.flatnonzero(np.append(True, met[1:] != met[:-1]))
    tokens = met[first], np.add.reduceat(np.take(dx.reshape(-1, WIDTH), order, axis=0), first, axis=0)
    places = (np.ones(n, kind) @ dx.reshape(n, -1)).reshape(CONTEXT, WIDTH)
    return loss / n_real, {
        "tokens": tokens, "places": places, "query": d_qkv[:, :WIDTH] / kind.type(np.sqrt(WIDTH)),
        "key": d_qkv[:, WIDTH : 2 * WIDTH], "value": d_qkv[:, 2 * WIDTH :], "out": d_out[:-1], "bias": d_out[-1],
    }


class Adam:
    """Steps on batches of windows; changes the weights of ``model``, of the embeddings only those met.

    All weights but the embeddings lie one after the other, so that a step changes them at once.
    """

    def __init__(self, model: Model):
        self.model, self.steps, self.room = model, 0, Room()
        self.names = [name for name in model.weights if name != "tokens"]
        small = [model.weights[name] for name in self.names]
        self.flat = np.concatenate([v.ravel() for v in small])
        for name, v, part in zip(self.names, small, np.split(self.flat, np.cumsum([v.size for v in small])[:-1])):
            model.weights[name] = part.reshape(v.shape)
        tokens = model.weights["tokens"]
        self.first, self.second = ((np.zeros_like(tokens), np.zeros_like(self.flat)) for _ in range(2))

    def step(self, x: np.ndarray, t: np.ndarray, rate: float, with_loss: bool = True) -> float:
        model = self.model
        self.steps += 1
        loss, grads = gradients(
            model.weights, model.slot[x], x == model.pad, model.classes[t], t != model.pad, self.room, with_loss
        )
        fix, fix2 = 1 - 0.9**self.steps, 1 - 0.99**self.steps
        met, d_tokens = grads["tokens"]
        d_flat = np.concatenate([grads[name].ravel() for name in self.names])
        parts = ((model.weights["tokens"], met, d_tokens), (self.flat, slice(None), d_flat))
        for (weights, at, d), all_first, all_second in zip(parts, self.first, self.second):
            first = all_first[at] * np.float32(0.9) + np.float32(0.1) * d
            second = all_second[at] * np.float32(0.99) + np.float32(0.01) * d * d
            all_first[at], all_second[at] = first, second
            weights[at] -= (rate * (first / fix) / (np.sqrt(second / fix2) + 1e-8)).astype(np.float32)
        return loss


def fit(model: Model, inputs: np.ndarray, targets: np.ndarray, steps: int = STEPS, seed: int = 11) -> list[float]:
    """Adam on random batches of windows; the loss of each step."""
    if not len(inputs):
        return []
    g = np.random.Generator(np.random.PCG64(seed))
    adam, losses = Adam(model), []
    for step in range(1, steps + 1):
        at = g.integers(0, len(inputs), BATCH)
        losses.append(adam.step(inputs[at], targets[at], RATE * min(1.0, 2 * (1 - step / (steps + 1)))))
    return losses


def word_ids(enc, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids of each text, and all ids, word by word as they are scored."""
    words, codes, bounds = word_codes(texts)
    begins, lengths, ids = enc.encode_dictionary(words, codes)
    sizes = lengths[codes]
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    return np.bincount(doc, sizes, len(bounds) - 1).astype(np.int64), ids[ragged(begins[codes], sizes)]


#: Weights times windows are summed as whole numbers of this unit.
_UNIT = 2.0**-20
#: Tasks that add up the weights of all others.
_ADDERS = 16


def _id_kind(enc) -> np.dtype:
    return np.dtype("<u2" if enc.size < 1 << 16 else "<u4")


def code(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``docs`` with the ids of ``text`` and ``place``, a hash of doc_id and text; written, so that each text is encoded once."""
    stay, schema = extended(docs.withColumn("place", F.xxhash64("doc_id", "text")), "ids binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, True)
        kind = _id_kind(enc)
        for batch in slices(batches, "text", 4 << 20):
            lengths, ids = word_ids(enc, batch.column("text"))
            offsets = np.concatenate([[0], np.cumsum(lengths)]) * kind.itemsize
            data = pa.Array.from_buffers(
                pa.binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(ids.astype(kind).tobytes())]
            )
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in stay), data], names=[*stay, "ids"])

    return written(docs.withColumn("place", F.xxhash64("doc_id", "text")).mapInArrow(run, schema), "ids")


def coded_ids(column: pa.Array, enc) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids of each row of a column that ``code`` made, and all ids."""
    kind, bounds = _id_kind(enc), _offsets(column)
    if not len(column):
        return np.empty(0, np.int64), np.empty(0, kind)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    return np.diff(bounds).astype(np.int64) // kind.itemsize, data.view(kind)


def deal(docs: DataFrame, tokenizer: str, shards: int) -> DataFrame:
    """shard, place, ids, round of every row of ``docs`` (doc_id, text, or as ``code`` gives them).

    Round, shard and place come from a hash of the row, so they do not depend on how the table lies in files.
    """
    coded = docs if "ids" in docs.columns else code(docs, tokenizer)
    return coded.select(
        F.pmod(F.shiftright("place", 16), F.lit(shards)).cast("int").alias("shard"),
        "place",
        "ids",
        F.pmod("place", F.lit(ROUNDS)).cast("int").alias("round"),
    )


def fit_all(docs: DataFrame, model: Model, tokenizer: str, n_windows: float, passes: int = 1) -> list[int]:
    """Trains on every row of ``docs`` (as for ``deal``), each in one round; the windows seen in each round.

    A round has as many shards as ``n_windows``, the windows of all rows, ask for. Each is trained on by itself
    from the same weights, which are averaged by windows seen.
    """
    spark, seen = docs.sparkSession, []
    shards = max(1, int(np.ceil(n_windows / (ROUNDS * SHARD_WINDOWS))))
    dealt = deal(docs, tokenizer, shards)
    for k in range(ROUNDS):
        shared = spark.sparkContext.broadcast(model)
        rate = RATE * min(1.0, 2 * (1 - (k + 0.5) / ROUNDS))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard: _Shard | None = None
            kind = _id_kind(encoder(tokenizer, True))
            for batch in batches:
                for number, data in zip(batch.column("shard").to_pylist(), batch.column("ids").to_pylist()):
                    if shard is None or shard.number != number:
                        if shard is not None:
                            yield shard.result()
                        shard = _Shard(shared.value, number, rate, passes, BATCH)
                    shard.add(np.frombuffer(data, kind))
            if shard is not None:
                yield shard.result()

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, total = 0, None
            for batch in batches:
                for m, part in zip(batch.column("n").to_pylist(), batch.column("total")):
                    values = np.frombuffer(part.as_buffer(), np.int64)
                    n, total = n + m, values if total is None else total + values
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tobytes()])], names=["n", "total"])

        schema = "n long, total binary"
        # With a number, since shards that were put together in few tasks would wait for each other.
        mine = dealt.where(F.col("round") == k).drop("round").repartition(3 * shards, "shard")
        parts = mine.sortWithinPartitions("shard", "place", "ids").select("shard", "ids").mapInArrow(run, schema)
        sums = parts.repartition(_ADDERS).mapInArrow(add, schema).collect()
        shared.unpersist()
        n = sum(r["n"] for r in sums)
        seen.append(n // passes)
        if n:
            flat = sum(np.frombuffer(r["total"], np.int64) for r in sums) * (_UNIT / n)
            edges = np.cumsum([v.size for v in model.weights.values()])[:-1]
            for (name, old), new in zip(list(model.weights.items()), np.split(flat, edges)):
                model.weights[name] = new.reshape(old.shape).astype(np.float32)
    return seen


class _Shard:
    """Training on one shard in one round. Documents are gathered up to a fixed number of ids, whatever batches they come in."""

    def __init__(self, start: Model, number: int, rate: float, passes: int, batch: int):
        self.number, self.rate, self.passes, self.batch = number, rate, passes, batch
        self.model = Model(start.classes, start.log_share, start.slot, {n: v.copy() for n, v in start.weights.items()})
        self.adam, self.n = Adam(self.model), 0
        self.order = np.random.Generator(np.random.PCG64([11, number]))
        self.held: list[np.ndarray] = []
        self.held_ids = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.held_ids += len(ids) + 1
        if self.held_ids >= GATHERED:
            self._train()

    def _train(self) -> None:
        lengths = np.array([len(x) for x in self.held], np.int64)
        inputs, targets, _ = windows(lengths, np.concatenate(self.held), self.model.end, self.model.pad)
        order = np.concatenate([self.order.permutation(len(inputs)) for _ in range(self.passes)])
        self.n += len(order)
        for at in np.array_split(order, max(1, round(len(order) / self.batch))):
            self.adam.step(inputs[at], targets[at], self.rate, with_loss=False)
        self.held, self.held_ids = [], 0

    def result(self) -> pa.RecordBatch:
        if self.held:
            self._train()
        flat = np.concatenate([v.ravel() for v in self.model.weights.values()]).astype(np.float64)
        total = np.rint(flat * self.n / _UNIT).astype(np.int64).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([self.n]), pa.array([total])], names=["n", "total"])


class Scorer:
    """Log probabilities of whole texts by a model."""

    def __init__(self, model: Model):
        self.model, self.room = model, Room()
        self.qkv, self.out = _projections(model.weights)

    def score(self, lengths: np.ndarray, ids: np.ndarray, at_once: int = 2 * _NEAR) -> np.ndarray:
        """Natural log probability of each document's ids and its end."""
        m = self.model
        out = np.zeros(len(lengths))
        edges = np.concatenate([[0], np.cumsum(-(-(lengths + 1) // STRIDE))])
        begin = 0
        while begin < len(lengths):  # some documents at a time, as their windows take many times the ids
            stop = max(begin + 1, int(np.searchsorted(edges, edges[begin] + 16 * at_once, side="right")) - 1)
            total = np.cumsum(lengths)
            some = ids[total[begin] - lengths[begin] : total[stop - 1]]
            inputs, targets, doc = windows(lengths[begin:stop], some, m.end, m.pad)
            for i in range(0, len(doc), at_once):
                out[begin:stop] += np.bincount(
                    doc[i : i + at_once], self._windows(inputs[i : i + at_once], targets[i : i + at_once]), stop - begin
                )
            begin = stop
        return out

    def _windows(self, x: np.ndarray, t: np.ndarray) -> np.ndarray:
        m, w = self.model, self.model.weights
        *_, h = _attended(w["tokens"], w["places"], self.qkv, m.slot[x], x[:, 0] == m.pad, self.room)
        z = _logits(h, self.out, self.room)
        n_classes = z.shape[2]
        target = t.ravel()
        hit = z.reshape(-1)[m.classes[target] + np.arange(0, z.size, n_classes)].astype(np.float64)
        np.exp(z, out=z)
        sums = z.reshape(-1, n_classes) @ np.ones(n_classes, z.dtype)
        value = hit - np.log(sums.astype(np.float64)) + m.log_share[target]
        value[target == m.pad] = 0
        return value.reshape(t.shape).sum(1)


def train(docs: DataFrame, counts: DataFrame, n_documents: int, tokenizer: str, text: str = "text") -> Model:
    """The model: counts of all training words (or ids, see ``id_counts``), weights from all training documents."""
    enc = encoder(tokenizer, True)
    ids = np.zeros(enc.size + 2)
    for i, n in id_counts(counts, tokenizer).items():
        ids[i] = n
    ids[enc.size] = n_documents
    classes, share, slot = classify(ids)
    smooth = np.bincount(classes, np.where(np.arange(len(ids)) == len(ids) - 1, 0, ids + 0.1), CLASSES)
    model = Model(classes, share, slot, start_weights(OWN_EMBEDDINGS + CLASSES + 1, CLASSES, smooth / smooth.sum()))
    if n_documents:
        n_windows = n_documents + ids[:-1].sum() / STRIDE
        passes = int(np.ceil(STEPS * BATCH / n_windows))
        fit_all(docs.where("train"), model, tokenizer, n_windows, passes)
    return model


def score(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"), held_out(id_column).alias("held_out"))
    rows = rows.withColumn("train", ~F.col("held_out"))
    counts = written(word_counts(rows), "word-counts")
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("word").alias("v")).first()
    ends = rows.where("train").count()
    n_all, distinct = sums["n"] + ends, sums["v"] + (ends > 0)
    # Words by powers of two of their counts: at most 64 rows.
    power = F.floor(F.log2("n")).cast("int").alias("power")
    by_power = {r["power"]: r["k"] for r in counts.groupBy(power).agg(F.count("word").alias("k")).collect()}
    least, taken = 1 << 62, 0
    for p in sorted(by_power, reverse=True):
        taken += by_power[p]
        if taken > TOP_WORDS:
            break
        least = 1 << p
    top = counts.where(F.col("n") >= least).toPandas()
    coded = code(rows, tokenizer)
    model = train(coded, coded.where("train"), ends, tokenizer, text)
    shared = spark.sparkContext.broadcast(
        (top["word"].tolist(), top["n"].to_numpy(np.int64), model)
    )
    log_all = float(np.log10(n_all + 0.1 * (distinct + 1)))
    end_score = float(np.log10(ends + 0.1)) - log_all

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_list, n_list, model = shared.value
        known, scorer, enc = pa.array(words_list, pa.large_string()), Scorer(model), encoder(tokenizer, True)
        gain = np.log10(np.concatenate([n_list, [0]]) + 0.1)
        part, row = TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text", 2 << 20):
            words, codes, bounds = word_codes(batch.column("text"))
            per_text = np.diff(bounds)
            doc = np.repeat(np.arange(len(per_text)), per_text)
            at = pc.index_in(words, value_set=known).fill_null(-1).to_numpy()[codes]
            base = np.bincount(doc, gain[at], len(per_text)) - per_text * log_all + end_score
            n_known = np.bincount(doc[at >= 0], minlength=len(per_text)) + (ends > 0)
            rare = np.flatnonzero(at < 0)
            rare_ends = np.concatenate([[0], np.cumsum(np.bincount(doc[rare], minlength=len(per_text)))])
            rare_words = pa.ListArray.from_arrays(
                pa.array(rare_ends.astype(np.int32)), words.take(pa.array(codes[rare])).cast(pa.string())
            )
            n_ids, stream = coded_ids(batch.column("ids"), enc)
            value = scorer.score(n_ids, stream) / np.log(10)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((part << 40) + row + np.arange(len(per_text))),
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(per_text + 1),
                    pa.array(n_known.astype(np.int64)),
                    pa.array(base),
                    pa.array(value),
                    rare_words,
                ],
                names=["row", "doc_id", "held_out", "n_tokens", "top_known", "top_score", "score", "rare"],
            )
            row += len(per_text)

    kind = docs.schema[id_column].dataType.simpleString()
    first = written(
        coded.select("doc_id", "text", "held_out", "ids").mapInArrow(
            run,
            f"row long, doc_id {kind}, held_out boolean, n_tokens long, top_known long, top_score double, score double, rare array<string>",
        ),
        "scores",
    )
    seen = first.select("row", F.explode("rare").alias("word")).join(counts, "word")
    more = seen.groupBy("row").agg(
        F.count(F.lit(1)).alias("n_more"), F.sum(F.log10((F.col("n") + 0.1) / 0.1)).alias("gain")
    )
    return first.drop("rare").join(more, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("top_known") + F.coalesce("n_more", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("top_score") + F.coalesce("gain", F.lit(0.0))).alias("base_score"),
        "score",
    )
