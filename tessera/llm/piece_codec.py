"""Piece ids of whole texts for merge-type models of the sentencepiece format, and texts from ids.

Encoding fills a table over the prefixes of a text. Greedy merging gives every prefix one row of pieces, and a row
of pieces is what merging gives exactly if any two neighbours are: the first merge across a border would happen
in the two pieces alone as well. So a prefix has one last piece: the piece found to end there, by an automaton of
all pieces, that may stand beside the last piece of the prefix before it. Ids are recovered from the end of the
text backwards. Time grows with the text, whatever its shape.

Two pieces may be neighbours if no merge across their border comes up while each is merged from its letters. The
merges of single pieces are recorded once; a pair replays both records side by side, and its answer is kept.
Merges go by score, then from left to right, as the library does it. Pieces that merging never gives, because
their letters end in other pieces, are left out of the automaton. Letters without a piece stand for themselves
and become the pieces of their bytes.

Where no piece of the model holds a blank after another letter, no piece goes across the beginning of a run of
blanks, and each distinct stretch from there is encoded once per worker. Other models take texts as one stretch.

Models with user-defined pieces, rules of normalization, or trimming of blanks are refused: they need more than
merging. Null text is empty and has the begin and end ids only. Rows are coded row by row, whatever their ids and
however often they are repeated; further columns stay, but those with the name of a new one give way to it.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import _offsets, extended, ragged, slices

#: What stands for a blank in pieces.
BLANK = "▁"
#: Kinds of pieces in model files.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Stretches and answers for pairs that a worker keeps.
_KEPT = 300_000
_PAIRS = 2_000_000
#: Bytes of text encoded at once.
_SLICE = 2 << 20
_STRETCH = re.compile(f"{BLANK}+[^{BLANK}]*")


def _read_model(path: str):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    norm = model.normalizer_spec
    plain = not norm.precompiled_charsmap and not norm.normalization_rule_tsv and not norm.remove_extra_whitespaces
    kinds = {p.type for p in model.pieces}
    if model.trainer_spec.model_type != 2 or not plain or not norm.escape_whitespaces or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError(f"{path}: not a merge-type model without normalization and user-defined pieces")
    return model


class Merges:
    """What greedy merging does to single pieces and to two of them side by side."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.records: dict[str, tuple[list[float], list[str], list[str]]] = {}
        self.answers: dict[tuple[str, str], bool] = {}

    def merged(self, letters: str) -> tuple[list[str], tuple[list[float], list[str], list[str]]]:
        """The pieces that merging gives, and its record: score of each merge, first and last piece before each and at the end."""
        row = list(letters)
        steps: tuple[list[float], list[str], list[str]] = ([], [row[0]], [row[-1]])
        while len(row) > 1:
            best, at = None, 0
            for i in range(len(row) - 1):
                score = self.scores.get(row[i] + row[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            row[at : at + 2] = [row[at] + row[at + 1]]
            steps[0].append(best)
            steps[1].append(row[0])
            steps[2].append(row[-1])
        return row, steps

    def _record(self, piece: str) -> tuple[list[float], list[str], list[str]]:
        found = self.records.get(piece)
        if found is None:
            found = self.records[piece] = self.merged(piece)[1]
        return found

    def neighbours(self, a: str, b: str) -> bool:
        """Whether merging the letters of ``a`` and ``b`` together ends in these two pieces."""
        answer = self.answers.get((a, b))
        if answer is None:
            if len(self.answers) >= _PAIRS:
                self.answers.clear()
            answer = self.answers[a, b] = self._replayed(a, b)
        return answer

    def _replayed(self, a: str, b: str) -> bool:
        (left_scores, _, last), (right_scores, first, _) = self._record(a), self._record(b)
        none = float("-inf")
        i = j = 0
        while True:
            left = left_scores[i] if i < len(left_scores) else none
            right = right_scores[j] if j < len(right_scores) else none
            across = self.scores.get(last[i] + first[j], none)
            if left == right == across == none:
                return True
            if left >= across and left >= right:
                i += 1
            elif across >= right:
                return False
            else:
                j += 1


class Codec:
    """Encodes and decodes by one model file."""

    def __init__(self, path: str):
        import ahocorasick

        model = _read_model(path)
        pieces = model.pieces
        self.ids = {p.piece: i for i, p in enumerate(pieces) if p.type == NORMAL}
        self.merges = Merges({p.piece: p.score for p in pieces if p.type == NORMAL})
        self.dummy = model.normalizer_spec.add_dummy_prefix
        self.by_stretch = self.dummy and not any(BLANK in p.lstrip(BLANK) for p in self.ids)
        control = {p.piece: i for i, p in enumerate(pieces) if p.type == CONTROL}
        spec = model.trainer_spec
        self.bos, self.eos = control.get(spec.bos_piece or "<s>", -1), control.get(spec.eos_piece or "</s>", -1)
        unknown = next(i for i, p in enumerate(pieces) if p.type == UNKNOWN)
        bytes_of = {i: int(p.piece[3:-1], 16) for i, p in enumerate(pieces) if p.type == BYTE}
        self.byte_ids = {b: i for i, b in bytes_of.items()}
        self.unknown = unknown
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            if self.merges.merged(p)[0] == [p]:
                self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        # Decoding: the bytes that each id stands for, and what kind of id it is.
        shown = [b""] * len(pieces)
        for p, i in self.ids.items():
            shown[i] = p.replace(BLANK, " ").encode()
        for i, b in bytes_of.items():
            shown[i] = bytes([b])
        shown[unknown] = spec.unk_surface.encode()
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_sizes = np.array([len(s) for s in shown], np.int64)
        self.shown_begins = np.cumsum(self.shown_sizes) - self.shown_sizes
        self.is_control = np.array([p.type == CONTROL for p in pieces])
        self.is_high = np.zeros(len(pieces), bool)  # a byte that needs others to be a letter
        self.is_high[[i for i, b in bytes_of.items() if b >= 0x80]] = True
        self.has_blank = np.zeros(len(pieces), bool)
        self.has_blank[[i for p, i in self.ids.items() if p.startswith(BLANK)]] = True
        self._forget()

    def _forget(self) -> None:
        self.stretches = _Stretches(self)
        self.stretches[self.bos], self.stretches[self.eos] = 0, 1
        self.begins, self.sizes = array("q", [0, 1]), array("q", [1, 1])
        self.held = array("I", [max(self.bos, 0), max(self.eos, 0)])

    def prefix_table(self, letters: str) -> list[str]:
        """The last piece of every prefix of ``letters``; letters without a piece are pieces of their own."""
        last = [""] * (len(letters) + 1)
        known, neighbours = self.merges.answers, self.merges.neighbours
        for end, piece in self.automaton.iter(letters):
            end += 1
            if last[end]:
                continue
            begin = end - len(piece)
            if not begin:
                last[end] = piece
                continue
            before = last[begin] or letters[begin - 1]
            fits = known.get((before, piece))
            if fits or (fits is None and neighbours(before, piece)):
                last[end] = piece
        return last

    def pieces(self, letters: str) -> list[str]:
        """The pieces of ``letters``, recovered from the end of its prefix table."""
        last = self.prefix_table(letters)
        end, out = len(letters), []
        while end:
            piece = last[end] or letters[end - 1]
            out.append(piece)
            end -= len(piece)
        out.reverse()
        return out

    def piece_ids(self, letters: str) -> list[int]:
        out = []
        for p in self.pieces(letters):
            i = self.ids.get(p)
            if i is not None:
                out.append(i)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in p.encode()]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def encode(self, texts: Iterable[str | None], begin: bool = True, end: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each text, and all ids one after the other."""
        codes: list[int] = []
        sizes = []
        code = self.stretches.__getitem__
        for text in texts:
            before = len(codes)
            if begin:
                codes.append(0)
            if text:
                letters = text.replace(" ", BLANK)
                if self.dummy:
                    letters = BLANK + letters
                codes += map(code, _STRETCH.findall(letters) if self.by_stretch else [letters])
            if end:
                codes.append(1)
            sizes.append(len(codes) - before)
        at = np.array(codes, np.int64)
        lengths = np.array(self.sizes, np.int64)[at]
        ids = np.array(self.held, np.uint32)[ragged(np.array(self.begins, np.int64)[at], lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])]
        if len(self.begins) > _KEPT or len(self.held) > 8 * _KEPT:
            self._forget()
        return np.diff(ends), ids

    def decode(self, sizes: np.ndarray, ids: np.ndarray) -> list[str]:
        """One text for each run of ``sizes[i]`` ids; bytes that form no letter become U+FFFD one by one."""
        ends = np.cumsum(sizes)
        begins = ends - sizes
        lengths = self.shown_sizes[ids]
        shown = self.shown[ragged(self.shown_begins[ids], lengths)].tobytes()
        shown_ends = np.concatenate([[0], np.cumsum(lengths)])
        spoken = np.flatnonzero(~self.is_control[ids])
        first = np.searchsorted(spoken, begins)
        high = self.is_high[ids]
        out = []
        for i, (b, e) in enumerate(zip(begins.tolist(), ends.tolist())):
            text = None
            begin, end = int(shown_ends[b]), int(shown_ends[e])
            if high[b:e].any():
                text = self._mended(ids[b:e], high[b:e])
            if text is None:
                text = shown[begin:end].decode()
            k = int(spoken[first[i]]) if first[i] < len(spoken) else e
            if self.dummy and k < e and self.has_blank[ids[k]]:
                text = text[1:]
            out.append(text)
        return out

    def _mended(self, ids: np.ndarray, high: np.ndarray) -> str | None:
        """The text of ids whose bytes do not all form letters; None if they do."""
        edges = np.flatnonzero(np.diff(np.concatenate([[False], high, [False]]).astype(np.int8)))
        runs = [(b, e, bytes(self.shown[self.shown_begins[ids[b:e]]])) for b, e in zip(edges[::2].tolist(), edges[1::2].tolist())]
        texts = [(b, e, _letters(run)) for b, e, run in runs]
        if all(t.encode() == run for (_, _, t), (_, _, run) in zip(texts, runs)):
            return None
        out, at = [], 0
        for b, e, t in [*texts, (len(ids), len(ids), "")]:
            some = ids[at:b]
            out.append(self.shown[ragged(self.shown_begins[some], self.shown_sizes[some])].tobytes().decode())
            out.append(t)
            at = e
        return "".join(out)


def _letters(run: bytes) -> str:
    """Bytes from 0x80 on as letters; each byte that is part of none as U+FFFD."""
    out, i = [], 0
    while i < len(run):
        size = 2 if run[i] < 0xE0 else 3 if run[i] < 0xF0 else 4
        try:
            letter = run[i : i + size].decode()
        except UnicodeDecodeError:
            letter = ""
        if len(letter) == 1:
            out.append(letter)
            i += size
        else:
            out.append("�")
            i += 1
    return "".join(out)


class _Stretches(dict):
    """The code of each stretch that was met; a new one is encoded."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec

    def __missing__(self, letters: str) -> int:
        c = self.codec
        ids = c.piece_ids(letters)
        code = len(c.begins)
        c.begins.append(len(c.held))
        c.sizes.append(len(ids))
        c.held.extend(ids)
        self[letters] = code
        return code


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, path: str, text: str = "text", begin: bool = True, end: bool = True) -> DataFrame:
    """``docs`` without its text, with ``n_tokens`` and ``ids``, little-endian unsigned 32-bit integers."""
    kept, schema = extended(docs, "n_tokens long, ids binary", drop=text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in slices(batches, text, _SLICE):
            sizes, ids = c.encode(batch.column(text).to_pylist(), begin, end)
            offsets = np.concatenate([[0], 4 * np.cumsum(sizes)]).astype(np.int32)
            data = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype("<u4").tobytes())])
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), pa.array(sizes, pa.int64()), data], names=schema.names)

    return docs.select(*kept, text).mapInArrow(run, schema)


def decode(coded: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``coded`` with the text of its ids in column ``into``; null ids give null."""
    kept, schema = extended(coded, f"{into} string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in slices(batches, ids, 2 * _SLICE):
            column = batch.column(ids)
            offsets = _offsets(column).astype(np.int64)
            data = column.buffers()[2]
            flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
            # A copy, since the bytes of a slice need not begin where a 32-bit number may.
            texts = c.decode(np.diff(offsets) // 4, np.frombuffer(flat.tobytes(), "<u4"))
            texts = [t if known else None for t, known in zip(texts, column.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), pa.array(texts, pa.string())], names=schema.names)

    return coded.select(*kept, *([] if ids in kept else [ids])).mapInArrow(run, schema)
