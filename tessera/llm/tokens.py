"""Token ids of whole texts with a public tokenizer file, in columns of Arrow batches.

Both tokenizer kinds cut a text at white space before anything else, so the ids of a text are the ids of
its space-separated pieces one after the other. A batch therefore encodes each distinct piece once and
gathers the ids of all rows from that, which gives the ids that encoding the whole text gives. Texts in
which two white-space characters meet, and those that hold a special token as text, take the whole-text call.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tessera.llm.common import _offsets, own_texts, ragged

#: RE2 pattern: white-space characters side by side.
_WHOLE = r"[\s\p{Z}\x0b\x1c-\x1f\x{85}]{2}"
#: Pieces that are one word for every tokenizer, and those that are a word and a run of marks.
_LETTERS = r"^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
_LETTERS_AND_MARKS = r"^[A-Za-zÀ-ÖØ-öø-ÿ]+[!-&(-/:-@\[-`{-~]+$"
#: Distinct pieces encoded in one call; longer strings spare calls, shorter ones keep caches warm.
_GROUP = 100
#: Most pieces that a worker keeps from slice to slice.
_KEPT = 200_000
#: Strings handed to the library at once.
_CALL = 200


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Encodes columns of texts. ``lower`` says that the tokenizer folds case, so A-Z may be folded first."""

    def __init__(self, path: str, lower: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core; threads cost memory
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.lower = lower
        #: Texts of special tokens, which the library takes for the tokens themselves.
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = pa.array([], pa.large_string())
        self.known_begins, self.known_lengths = np.empty(0, np.int64), np.empty(0, np.int64)
        self.known_ids = np.empty(0, np.uint32)
        vocab = self.tokenizer.get_vocab()
        self.size = max(vocab.values()) + 1
        #: Ids that begin with a space, in byte-level tokenizers, and ids that end a word, in the others.
        self.starts, self.ends = np.zeros(self.size, bool), np.zeros(self.size, bool)
        self.starts[[i for t, i in vocab.items() if t.startswith("Ġ")]] = True
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for i in range(0, len(texts), _CALL):  # the library's results are many times larger than the ids
            found += [np.array(x, np.uint32) for x in self._ids(texts[i : i + _CALL])]
        return np.array([len(x) for x in found], np.int64), np.concatenate(found) if found else np.empty(0, np.uint32)

    def _joined(self, pieces: list[str], per_piece: int) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and ids of pieces that all give ``per_piece`` words with a word-end mark."""
        groups = [" ".join(pieces[i : i + _GROUP]) for i in range(0, len(pieces), _GROUP)]
        _, ids = self._flat(groups)
        return np.diff(np.flatnonzero(self.ends[ids])[per_piece - 1 :: per_piece], prepend=-1), ids

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and ids of `` piece`` for each non-empty piece; each holds no space."""
        if not self.lower:
            groups = [" " + " ".join(pieces[i : i + _GROUP]) for i in range(0, len(pieces), _GROUP)]
            _, ids = self._flat(groups)
            lengths = np.diff(np.flatnonzero(self.starts[ids]), append=len(ids))
            if len(lengths) != len(pieces):
                return self._flat([" " + p for p in pieces])
            return lengths, ids
        column = pa.array(pieces, pa.large_string())
        kinds = np.zeros(len(pieces), np.int8)
        for kind, pattern in ((1, _LETTERS), (2, _LETTERS_AND_MARKS)):
            kinds[pc.match_substring_regex(column, pattern).to_numpy(zero_copy_only=False)] = kind
        lengths, begins = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        parts, total = [], 0
        for kind in (0, 1, 2):
            at = np.flatnonzero(kinds == kind)
            some = [pieces[i] for i in at.tolist()]
            found, ids = self._joined(some, kind) if kind else self._flat(some)
            if len(found) != len(some) or found.sum() != len(ids):
                found, ids = self._flat(some)
            lengths[at], begins[at] = found, total + np.cumsum(found) - found
            parts.append(ids)
            total += len(ids)
        return lengths, np.concatenate(parts)[ragged(begins, lengths)]

    def encode_dictionary(self, words: pa.Array, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of each distinct piece begin, how many they are, and the ids.

        Pieces that were met twice in a slice are kept for the next ones, up to ``_KEPT``.
        """
        at = pc.index_in(words, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        pieces = words.take(pa.array(new)).to_pylist()
        filled = np.array([bool(p) for p in pieces], bool)
        new_lengths = np.zeros(len(new), np.int64)
        new_lengths[filled], new_ids = self.encode_pieces([p for p in pieces if p])
        if not filled.all():  # the space at an end of a text
            k = int(np.flatnonzero(~filled)[0])
            space = self._flat([" "])[1]
            before = int(new_lengths[:k].sum())
            new_lengths[k] = len(space)
            new_ids = np.concatenate([new_ids[:before], space, new_ids[before:]])
        new_begins = np.cumsum(new_lengths) - new_lengths
        lengths, begins = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        lengths[new], begins[new] = new_lengths, len(self.known_ids) + new_begins
        old = np.flatnonzero(at >= 0)
        lengths[old], begins[old] = self.known_lengths[at[old]], self.known_begins[at[old]]
        ids = np.concatenate([self.known_ids, new_ids])
        room = _KEPT - len(self.known)
        if room > 0:
            often = np.flatnonzero(np.bincount(codes, minlength=len(words))[new] > 1)[:room]
            self.known = pa.concat_arrays([self.known, words.take(pa.array(new[often]))])
            self.known_begins = np.concatenate([self.known_begins, len(self.known_ids) + np.cumsum(new_lengths[often]) - new_lengths[often]])
            self.known_lengths = np.concatenate([self.known_lengths, new_lengths[often]])
            self.known_ids = np.concatenate([self.known_ids, new_ids[ragged(new_begins[often], new_lengths[often])]])
        return begins, lengths, ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each text, and all ids one after the other; null is empty."""
        texts = own_texts(texts)
        n = len(texts)
        if not n:
            return np.empty(0, np.int64), np.empty(0, np.uint32)
        whole = pc.match_substring_regex(texts, _WHOLE).to_numpy(zero_copy_only=False)
        for special in self.special:
            # Case is folded before the pieces are encoded, so other cases must not reach that either.
            found = pc.match_substring(texts, special, ignore_case=self.lower)
            whole = whole | found.to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(whole), "", texts)
        split = pc.split_pattern(pc.ascii_lower(plain) if self.lower else plain, " ")
        bounds = _offsets(split).astype(np.int64)
        coded = split.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        words = coded.dictionary
        begins, lengths, ids = self.encode_dictionary(words, codes)
        # Parts: 0..V-1 the pieces with a space before, then the first piece of each text, then whole texts.
        # Where white space is dropped, a first piece is like any other.
        heads = [] if self.lower else words.take(pa.array(codes[bounds[:-1]])).to_pylist()
        firsts, first_ids = self._flat(heads)
        wholes, whole_ids = self._flat(texts.filter(pa.array(whole)).to_pylist())
        v, at_whole = len(words), np.flatnonzero(whole)
        parts = codes.copy()
        if not self.lower:
            parts[bounds[:-1]] = v + np.arange(n)
        parts[bounds[at_whole]] = v + len(firsts) + np.arange(len(at_whole))
        sizes = np.concatenate([lengths, firsts, wholes])
        more = len(ids) + np.cumsum(sizes[v:]) - sizes[v:]
        out = np.concatenate([ids, first_ids, whole_ids])[ragged(np.concatenate([begins, more])[parts], sizes[parts])]
        ends = np.concatenate([[0], np.cumsum(sizes[parts])])
        return np.diff(ends[bounds]), out


@lru_cache(maxsize=4)
def encoder(path: str, lower: bool) -> Encoder:
    return Encoder(path, lower)
