"""Quality by weak supervision: rules vote or abstain, and a posterior decides.

Each rule looks at counts of one document and votes good, bad or abstains. Expectation-maximisation
over the counts of all vote patterns estimates how often documents are good and how reliable each rule
is; a document stays when its posterior probability of being good is at least one half.

Everything on the data is DataFrame functions. The patterns, at most 3 to the number of rules whatever
the corpus, are the only thing that reaches the driver, where the estimation is a few lines of
arithmetic.

Null text has no words. Rows are judged one by one, so repeated rows, null or repeated ids and extra
columns change nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WORD_GAP, text_or_empty, written

WINDOW = 5

GOOD, BAD, ABSTAIN = 1, 0, -1

#: Names of the columns that measuring adds.
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_WORK = "__q_"


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the five counts, n_lines and n_distinct_words; columns of these names are replaced.

    Windows are compared by 64-bit hashes. Only texts in which some window hash repeats take the
    sorting step.
    """
    base = docs.drop(*MEASURES, "n_lines", "n_distinct_words")
    words, lines, windows = _WORK + "words", _WORK + "lines", _WORK + "windows"
    split = (
        base.withColumn(words, F.array_remove(F.split(text_or_empty(text), WORD_GAP), ""))
        .withColumn(lines, F.filter(F.split(text_or_empty(text), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    )
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(F.col(words), i + k) for k in range(WINDOW)]))
    hashed = split.withColumn(
        windows, F.when(F.size(words) >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>"))
    )
    return hashed.select(
        *base.columns,
        F.size(words).cast("long").alias("n_words"),
        F.length(F.regexp_replace(text_or_empty(text), WORD_GAP, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text_or_empty(text), r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col(windows)).cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.array_distinct(words)).cast("long").alias("n_distinct_words"),
    )


def _repeated_words(windows: Column) -> Column:
    """Words inside windows whose hash occurs again: sort (hash, start), keep equal neighbours, add up."""
    order = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def counted(pairs: Column) -> Column:
        def again(x: Column, k: Column) -> Column:
            before, after = F.get(pairs, k - 1)["h"], F.get(pairs, k + 1)["h"]
            return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

        return F.sort_array(F.transform(F.filter(pairs, again), lambda x: x["i"]))

    def covered(starts: Column) -> Column:
        widths = F.transform(
            starts, lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - s, F.lit(WINDOW)))
        )
        return F.aggregate(widths, F.lit(0), lambda a, b: a + b)

    # A one-element transform binds an expression to a name, so that it is evaluated once.
    bound = F.transform(F.array(order), counted)
    slow = F.get(F.transform(bound, covered), 0)
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(slow)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _vote(bad: Column, good: Column | None = None) -> Column:
    vote = F.when(bad, BAD)
    return (vote if good is None else vote.when(good, GOOD)).otherwise(ABSTAIN)


def rules() -> dict[str, Column]:
    """The voting rules over measured columns. A rule that only finds a defect never votes good."""
    words, chars = F.col("n_words"), F.col("word_chars")
    return {
        "length": _vote(words < 10, words >= 30),
        "variety": _vote(
            (words >= 50) & (F.col("n_distinct_words") * 8 < words),
            (words >= 30) & (F.col("n_distinct_words") * 4 >= words),
        ),
        "symbols": _vote(F.col("n_symbols") * 4 > words),
        "word_length": _vote((chars < 2 * words) | (chars > 15 * words)),
        "duplicate_lines": _vote(F.col("n_dup_lines") * 2 > F.col("n_lines")),
        "repeated_words": _vote(F.col("n_repeat_words") * 5 > words),
    }


def vote_counts(measured: DataFrame) -> list[tuple[tuple[int, ...], int]]:
    """How many documents cast each pattern of votes; at most 3 ** number of rules rows."""
    names = list(rules())
    counts = measured.select(*[c.alias(n) for n, c in rules().items()]).groupBy(*names).count()
    return [(tuple(r[n] for n in names), r["count"]) for r in counts.collect()]


#: For good and for bad documents: by rule the share of each vote.
Shares = tuple[list[dict[int, float]], list[dict[int, float]]]


def _bounded(good: dict[int, float], bad: dict[int, float]) -> tuple[dict[int, float], dict[int, float]]:
    """Shares within what makes a rule a rule: it seldom faults good documents and often faults bad ones."""
    good, bad = dict(good), dict(bad)
    good[BAD] = min(0.02, max(0.0005, good[BAD]))
    bad[BAD] = min(0.95, max(0.2, bad[BAD]))
    for shares in (good, bad):
        rest = (1 - shares[BAD]) / max(1e-9, shares[GOOD] + shares[ABSTAIN])
        shares[GOOD], shares[ABSTAIN] = shares[GOOD] * rest, shares[ABSTAIN] * rest
    if good[GOOD]:
        top = good[GOOD]
        bad[GOOD] = min(max(bad[GOOD], top / 1.5), top)
        bad[ABSTAIN] = max(0.0, 1 - bad[BAD] - bad[GOOD])
    return good, bad


def estimate(
    patterns: list[tuple[tuple[int, ...], int]], n_rules: int, rounds: int = 50
) -> tuple[float, Shares]:
    """Share of good documents and the vote shares by expectation-maximisation.

    The share of good documents stays between 0.5 and 0.98 and vote shares within ``_bounded``, so a rule
    cannot turn into its opposite and no class can vanish. Without documents the start values come back.
    """
    votes_good = [any(v[j] == GOOD for v, _ in patterns) for j in range(n_rules)]
    start = [
        ({GOOD: 0.8, ABSTAIN: 0.195, BAD: 0.005}, {GOOD: 0.5, ABSTAIN: 0.1, BAD: 0.4})
        if both
        else ({GOOD: 0.0, ABSTAIN: 0.995, BAD: 0.005}, {GOOD: 0.0, ABSTAIN: 0.6, BAD: 0.4})
        for both in votes_good
    ]
    prior, shares = 0.9, ([g for g, _ in start], [b for _, b in start])
    total = sum(n for _, n in patterns)
    if not total:
        return prior, shares
    for _ in range(rounds):
        weighted = [(votes, n, posterior(votes, prior, shares)) for votes, n in patterns]
        good_sum = sum(n * p for _, n, p in weighted)
        prior = min(0.98, max(0.5, good_sum / total))
        pairs = []
        for j in range(n_rules):
            sums = [{GOOD: 0.0, ABSTAIN: 0.0, BAD: 0.0} for _ in range(2)]
            for votes, n, p in weighted:
                sums[0][votes[j]] += n * p
                sums[1][votes[j]] += n * (1 - p)
            pairs.append(_bounded(*[{v: x / max(1e-9, sum(s.values())) for v, x in s.items()} for s in sums]))
        shares = [g for g, _ in pairs], [b for _, b in pairs]
    return prior, shares


def weights(prior: float, shares: Shares) -> tuple[float, list[dict[int, float]]]:
    """Log-odds of the prior, and by rule what each vote adds to it; abstaining says nothing."""
    tiny = 1e-9
    odds = [{v: math.log((g[v] + tiny) / (b[v] + tiny)) for v in g} | {ABSTAIN: 0.0} for g, b in zip(*shares)]
    return math.log(prior / (1 - prior)), odds


def posterior(votes: tuple[int, ...], prior: float, shares: Shares) -> float:
    start, odds = weights(prior, shares)
    return 1 / (1 + math.exp(-(start + sum(o[v] for v, o in zip(votes, odds)))))


def judge(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with the counts, ``base_failed``, ``quality`` (the posterior) and ``kept``.

    The measured rows are written once; the votes are counted from that table and judged on it.
    """
    measured = measure(docs, text)
    measured = written(measured if keep_text else measured.drop(text), "quality")
    start, odds = weights(*estimate(vote_counts(measured), len(rules())))
    added = [
        F.when(v == GOOD, F.lit(o[GOOD])).when(v == BAD, F.lit(o[BAD])).otherwise(F.lit(0.0))
        for v, o in zip(rules().values(), odds)
    ]
    log_odds = reduce(lambda a, b: a + b, added, F.lit(start))
    return measured.withColumns({"base_failed": base_failed(), "quality": 1 / (1 + F.exp(-log_odds))}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)
    )
