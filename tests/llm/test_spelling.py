"""Spelling variants against a comparison of all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import queries, spelling


def edits(word):
    """All strings at one edit whose letters are those of a small alphabet."""
    letters = "abcdéÿ"
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            for c in letters:
                yield word[:i] + c + word[i + 1 :]


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain_words(rows, every=31):
    """Counts by the definition, with patterns and single code points."""
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def plain_groups(counts):
    """Near words by looking up every deletion, so that all pairs are seen without comparing all."""
    keys = {}
    for w in counts:
        for k in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            keys.setdefault(k, []).append(w)
    near = {w: set() for w in counts}
    for group in keys.values():
        for a in group:
            near[a].update(b for b in group if one_apart(a, b))
    forms = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 10 * n:
            forms[w] = best
    out = set()
    for w, n in counts.items():
        root = w
        while root in forms:
            root = forms[root]
        form = forms.get(w)
        out.add((w, form, root, n, len(near[w]), counts[form] if form else None))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_lists_find_all_pairs(seed):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 9))) for _ in range(300)}
    words |= {w for base in list(words)[:10] for w in edits(base) if w}
    words = sorted(words)
    q, v, agree = spelling.near_pairs(np.zeros(len(words), np.int64), [w.encode("latin-1") for w in words], np.zeros(len(words), np.int64))
    pairs = [(words[a], words[b]) for a, b in zip(q, v)]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in words for b in words if one_apart(a, b)}
    for a, b, k in zip(q, v, agree):
        same = next((i for i in range(min(len(words[a]), len(words[b]))) if words[a][i] != words[b][i]), min(len(words[a]), len(words[b])))
        assert same == k


def test_lists_begin_at_shared_prefixes_and_keep_hash_clashes_apart():
    words = [b"abcdefg", b"abcdefx", b"zbcdefg", b"abcabca", b"abcabcab"]
    keys, lo = np.array([1, 1, 1, 2, 2]), np.array([3, 3, 3, 6, 6])
    q, v, agree = spelling.near_pairs(keys, words, lo)
    assert sorted(zip(q.tolist(), v.tolist(), agree.tolist())) == [(0, 1, 6), (1, 0, 6), (3, 4, 7), (4, 3, 7)]


@pytest.mark.parametrize("most", [4000, 3])
def test_neighbours_at_any_list_length(spark, most):
    """Short limits split every list down to one free code point; nothing may get lost or double."""
    rng = random.Random(most)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(7, 12))) for _ in range(60)}
    words |= {w for base in list(words)[:8] for w in edits(base) if len(w) >= 7}
    words |= {"a" * k for k in range(7, 40)}
    counts = {w: rng.choice([2, 2, 3, 20, 200]) for w in words}
    df = spark.createDataFrame(sorted(counts.items()), "word string, n long")
    got = {(r.word, r.n_near, r.near, r.near_n) for r in spelling.neighbours(df, 7, most).collect()}
    expected = set()
    for w in words:
        near = [v for v in words if one_apart(w, v)]
        if near:
            best = min(near, key=lambda v: (-counts[v], v))
            expected.add((w, len(near), best, counts[best]))
    assert got == expected


def test_query_against_plain_version(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    expected = plain_groups(plain_words(rows))
    df = queries.QUERIES["op11_sorted_variants"](spark, folder)
    got = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(got) == len(expected) and set(got) == expected
    assert sum(r[1] is not None for r in got) > 10
    assert dict(df.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}


def test_chains_lead_to_the_last_form(spark):
    text = ["abcdefgh"] * 2 + ["abcdefghi"] * 20 + ["abcdefghij"] * 200 + ["abcdefghijk"] * 2000 + ["zzzzzzzz"] * 2
    df = spark.createDataFrame([(1, " ".join(text))], "doc_id long, text string")
    got = {r.word: (r.form, r.root, r.n_near, r.form_n) for r in spelling.group(df).collect()}
    assert got["abcdefgh"] == ("abcdefghi", "abcdefghijk", 1, 20)
    assert got["abcdefghij"] == ("abcdefghijk", "abcdefghijk", 2, 2000)
    assert got["abcdefghijk"] == (None, "abcdefghijk", 1, None)
    assert got["zzzzzzzz"] == (None, "zzzzzzzz", 0, None)


def test_odd_rows(spark):
    long_run = "q" * 30_000
    rows = [
        (1, None, 0), (2, "", 0), (None, "Ünicode Ünicode", 0), (3, f"{long_run} {long_run} {long_run[1:]} {long_run[1:]}", 0),
        (4, "ABCDEFGH abcdefgh abcdefgň abcdefgx abcdefgx 1234567", 0), (4, "ABCDEFGH abcdefgh abcdefgň abcdefgx abcdefgx 1234567", 0),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, word int")
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.group(df, alter_every=31).collect()}
    assert got == plain_groups(plain_words([r[:2] for r in rows]))
    assert any(len(r[0]) == len(long_run) and r[4] == 1 for r in got)
    assert spelling.group(df.limit(0)).collect() == []
