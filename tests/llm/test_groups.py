"""Line runs, near-duplicates, decontamination and quality against plain versions and SQL."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import decontaminate, line_dedup, near_dups, quality, queries
from tests.llm.odd_tables import PROSE, none, odd
from tests.oracle import connect, differences

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, small, key):
    assert differences(queries.QUERIES[key](spark, small), connect(small), queries.ORACLES[key]) == []


def plain_repeats(rows, min_words):
    """Places of later copies by brute force; rows of (doc, text) in order."""
    seen, gone = set(), defaultdict(set)
    for doc, text in rows:
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        for i in range(len(lines)):
            n, m = 0, 0
            while n < min_words and i + m < len(lines):
                n += len(WORD.findall(lines[i + m]))
                m += 1
            if n >= min_words:
                window = tuple(lines[i : i + m])
                if window in seen:
                    gone[doc] |= set(range(i, i + m))
                seen.add(window)
    return gone


def test_repeated_runs_by_brute_force(spark):
    r = random.Random(3)
    pool = [" ".join(r.choices("abcdefg", k=r.randint(1, 9))) for _ in range(12)]
    rows = [(i, "\n".join(r.choices([*pool, "", " ", "fresh " + str(r.random())], k=r.randint(0, 40)))) for i in range(60)]
    got = line_dedup.remove(spark.createDataFrame(rows, "doc_id long, text string"), min_words=12).collect()
    gone = plain_repeats(rows, 12)
    assert sum(map(len, gone.values())) > 20
    texts = dict(rows)
    for x in got:
        places = sorted(gone[x.doc_id])
        assert x.removed == ",".join(map(str, places)) and x.n_removed == len(places)
        n, lines = -1, []
        for line in texts[x.doc_id].split("\n"):
            n += bool(WORD.search(line))
            if not (WORD.search(line) and n in gone[x.doc_id]):
                lines.append(line)
        assert x.text == "\n".join(lines)


def plain_runs(rows, min_words):
    """Places of later copies of runs of all lengths by brute force; rows of (doc, text) in order."""
    seen, gone = set(), defaultdict(set)
    for doc, text in rows:
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        for i in range(len(lines)):
            for j in range(i + 1, len(lines) + 1):
                run = tuple(lines[i:j])
                if len(WORD.findall(" ".join(run))) >= min_words:
                    if run in seen:
                        gone[doc] |= set(range(i, j))
                    seen.add(run)
    return gone


def test_whole_runs_by_brute_force(spark):
    r = random.Random(4)
    pool = [" ".join(r.choices("abcdefg", k=r.randint(1, 9))) for _ in range(12)]
    rows = [(i, "\n".join(r.choices([*pool, "", " ", "fresh " + str(r.random())], k=r.randint(0, 40)))) for i in range(60)]
    run = [" ".join(f"w{n}x{j}" for j in range(n)) for n in (6, 7, 3, 1)]
    rows += [(60, "\n".join([*run, "one"])), (61, "\n".join(["two", *run, "three"]))]
    want = plain_runs(rows, 12)
    assert want[61] == {1, 2, 3, 4} and want != plain_repeats(rows, 12)
    got = line_dedup.remove(spark.createDataFrame(rows, "doc_id long, text string"), min_words=12, whole=True).collect()
    assert {x.doc_id: x.removed for x in got} == {d: ",".join(map(str, sorted(want[d]))) for d, _ in rows}


def test_equal_rows_are_one_position_at_every_level(spark):
    text = "\n".join(f"line {i} of many" for i in range(40))
    docs = spark.createDataFrame([(1, text), (2, text), (2, text), *[(None, text)] * 5], "doc_id long, text string")
    lines = line_dedup.sequences(docs, 50)
    assert [x.count() for x in line_dedup.suffix_ranks(lines, 32)] == [3 * (41 - 2**k) for k in range(6)]
    for whole in (False, True):
        rows = line_dedup.remove(docs, whole=whole).collect()
        assert sorted(x.n_removed for x in rows) == [0] + [40] * 7


def test_windows_of_all_levels_share_their_joins(spark):
    """The plan does not grow with the levels, so the driver holds few stages at a time."""
    docs = spark.createDataFrame([(i, "\n".join(f"line {j} of many" for j in range(i, 40))) for i in range(4)], "doc_id long, text string")
    for min_words in (4, 50):
        found = line_dedup.later_copies(docs, min_words, whole=True)
        assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
        assert found.count() == 3


def test_repeated_runs_on_odd_rows(spark):
    rows = line_dedup.remove(odd(spark)).collect()
    by = defaultdict(list)
    for x in rows:
        by[x.doc_id].append(x)
    assert len(rows) == odd(spark).count() and by[1][0].text == PROSE and by[4][0].text is None
    assert [x.text for x in by[2]] == ["", ""] and by[3][0].text == PROSE.split("\n")[0].replace("p0q0", "changed")
    assert by[1][0].kept == "a" and by[1][0].n_words == 7
    assert line_dedup.remove(none(spark)).count() == 0


def plain_components(rows):
    sets = {}
    for doc, text in rows:
        w = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
        sets[doc] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    label = {d: d for d in sets}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    docs = sorted(sets)
    for i, a in enumerate(docs):
        for b in docs[i + 1 :]:
            k = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * k >= 75 * (len(sets[a]) + len(sets[b]) - k):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {d: (len(sets[d]), root(d)) for d in sets}


def test_near_duplicates_by_brute_force(spark, monkeypatch):
    r = random.Random(5)
    rows, words = [], [f"w{i}" for i in range(400)]
    for g in range(12):
        base = r.choices(words, k=r.randint(3, 120))
        for _ in range(r.randint(1, 12)):  # a walk, so that ends of a group are only linked through others
            base = [r.choice(words) if r.random() < 0.01 else w for w in base]
            rows.append((len(rows), " ".join(base)))
    want = plain_components(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in near_dups.link(docs).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) < len(rows)


def test_near_duplicates_on_odd_rows(spark):
    rows = near_dups.link(odd(spark)).collect()
    by = {x.doc_id: x for x in rows if x.doc_id is not None}
    assert len(rows) == odd(spark).count()
    assert by[2].component_id == by[3].component_id == 1 and not by[3].kept and by[1].kept
    assert all(by[d].component_id == d and by[d].kept and by[d].n_shingles == 0 for d in (4, 5, 6))
    assert all(x.component_id is None and x.kept for x in rows if x.doc_id is None)
    assert by[9].n_shingles == 1
    assert near_dups.link(none(spark)).count() == 0


def test_odd_sketches_estimate_high_similarities():
    g = np.random.Generator(np.random.PCG64(1))
    for true in (0.75, 0.9, 1.0):
        gaps = []
        for _ in range(40):
            n = 1000
            shared = round(2 * n * true / (1 + true))
            v = g.integers(0, 1 << 63, 2 * n - shared, dtype=np.uint64)
            both = np.concatenate([v[:n], v[n - shared :]])
            sketch = near_dups.odd_sketches(near_dups.min_hashes(np.array([n, n]), both))
            bits = int(np.bitwise_count(sketch[0] ^ sketch[1]).sum())
            assert bits <= near_dups.MOST_XOR
            gaps.append(near_dups.estimated_similarity(bits) - true)
        assert abs(np.mean(gaps)) < 0.03
    assert near_dups.estimated_similarity(near_dups.MOST_XOR) < 0.46


def test_buckets_of_repeated_rows_are_told_apart(spark):
    buckets = {10: (1, 5, 9), 11: (1, 6, 9), 12: (1, 5, 9), 13: (4, 4, 4)}
    rows = [(n, b) for b, nodes in buckets.items() for n in nodes] * 2
    got = near_dups.distinct_buckets(spark.createDataFrame(rows, "node long, bucket long")).collect()
    assert sorted(tuple(r) for r in got) == [(10, 1, 6), (11, 1, 6)]


def test_components_of_long_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (103, 101)], "a long, b long")
    got = {r.node: r.label for r in near_dups.components(links).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[103] == got[101] == 100


def test_decontamination_with_null_items_and_any_column_names(spark):
    text = "one two three four five six seven eight nine ten eleven"
    schema = "doc_id long, text string, __words string, c_doc int, candidates string, __hits int, item_id string, word_list int, __row int"
    rows = [(1, f"x {text} y", "w", 1, "c", 2, "i", 3, 4), (2, "other words", "w2", 5, "c2", 6, "i2", 7, 8), (3, "a b", None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    items = spark.createDataFrame([(None, text), (None, "a b"), ("k", text)], "item_id string, text string")
    found = {r.doc_id: r for r in decontaminate.report(docs, items).collect()}
    assert [(found[i].n_hit, found[i].n_items, found[i].contaminated) for i in (1, 2, 3)] == [(11, 2, True), (0, 0, False), (2, 1, True)]
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [rows[1]]


def test_decontamination_on_odd_rows(spark):
    items = spark.createDataFrame(
        [(1, " ".join(f"p1q{j}" for j in range(12))), (2, None), (3, "..."), (4, "X"), (5, "never seen words"), (6, "straße 日本語")],
        "item_id long, text string",
    )
    rows = decontaminate.report(odd(spark), items).collect()
    by = {x.doc_id: x for x in rows}
    assert len(rows) == odd(spark).count()
    assert (by[1].n_hit, by[1].n_items, by[1].contaminated) == (12, 1, True)
    assert (by[9].n_hit, by[9].n_items) == (1, 1) and (by[8].n_hit, by[8].n_items) == (2, 1)
    assert not by[4].contaminated and by[4].n_words == 0 and not by[None].contaminated
    assert decontaminate.report(none(spark), items).count() == 0
    assert not any(x.contaminated for x in decontaminate.report(odd(spark), items.where("false")).collect())


def test_proximity_finds_words_that_moved_apart(spark):
    docs = spark.createDataFrame([(1, "alpha one beta"), (2, "alpha beta"), (3, "beta alpha")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "alpha beta")], "item_id long, text string")
    anchors = decontaminate.anchored(docs, decontaminate.windows_of(items))
    postings = decontaminate.index(docs, anchors)
    assert {r.doc_id for r in decontaminate.candidates(postings, anchors).collect()} == {2}
    assert {r.doc_id for r in decontaminate.near_hits(postings, anchors, 2).collect()} == {1, 3}


def plain_measures(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    counts, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if counts[x] > 1:
            covered |= set(range(i, i + 5))
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_measures_and_votes(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    rows = queries.op6_quality_votes(spark, small).collect()
    right = []
    for r in rows:
        n = plain_measures(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 10 or 100 * n[4] > 20 * n[0])
        assert not (r.base_failed and r.kept)
        if r.doc_id in labels and not r.base_failed:
            right.append(r.kept == (labels[r.doc_id] == 1))
    assert sum(right) / len(right) > 0.95


def test_quality_on_odd_rows(spark):
    rows = quality.judge(odd(spark)).collect()
    assert len(rows) == odd(spark).count()
    for r in rows:
        assert r.n_words == plain_measures(r.text)[0] and isinstance(r.kept, bool)
    assert quality.judge(none(spark)).count() == 0


def test_estimation_keeps_rules_upright():
    patterns = [((1, -1), 90), ((1, 0), 8), ((0, 0), 2)]
    prior, shares = quality.estimate(patterns, 2)
    assert 0.5 <= prior <= 0.98
    assert quality.posterior((1, -1), prior, shares) > 0.5 > quality.posterior((0, 0), prior, shares)
    assert quality.estimate([], 2)[0] == 0.9


def test_quality_plan_has_no_python(spark, small):
    for key in ("op6_quality_votes", "op7_positional_index"):
        plan = queries.QUERIES[key](spark, small)._jdf.queryExecution().executedPlan().toString()
        assert not [w for w in ("Python", "Arrow", "Pandas", "NestedLoop", "Cartesian") if w in plan]
