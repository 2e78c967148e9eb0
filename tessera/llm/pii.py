"""Personal data by weak supervision.

Four fixed kinds (email, ip, card, phone) are found by their patterns and always reported. Looser
patterns propose further spans: local phone numbers, social-security numbers, bank account numbers,
spelled-out addresses and short card numbers. Labelers of three sorts (form, gazetteer, context) vote on
every proposed and fixed span. Expectation-maximisation over the counts of all vote patterns estimates
how reliable each labeler is; the posteriors train a logistic span classifier, and proposed spans that
it accepts are added.

Finding and voting run once over the texts and are written; what is estimated and trained sees only
counts per vote pattern, of which there are at most ``kinds * 3 ** labelers``, over all documents.

Null text is empty. Every row is searched by itself: repeated rows, null ids and extra columns make no
difference, and an empty table gives an empty result. All scans are linear in the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Taken, extended, slices, written

BASE_KINDS = ["email", "ip", "card", "phone"]
MORE_KINDS = ["phone_local", "ssn", "iban", "email_spoken", "card_short"]
KINDS = BASE_KINDS + MORE_KINDS
LABELERS = ["form", "gazetteer", "cue_before", "neighbours", "variety"]

PII, CLEAN, ABSTAIN = 1, 0, -1

#: Share of personal data and of right votes from which the estimation starts.
START_PRIOR, START_RIGHT = 0.5, 0.8
#: A proposed span is added from this probability on.
ACCEPT = 0.5

_LOCAL_CLASS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_MORE = {
    "phone_local": re.compile(r"(?<![\w+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.][0-9]{4}(?!\w)"),
    "ssn": re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?!\w)"),
    "email_spoken": re.compile(
        r"(?<![\w.])[A-Za-z0-9._-]{1,64}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,63}"
        r"(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]{1,63}){1,4}"
    ),
    "card_short": re.compile(r"(?<![\w-])[0-9](?:[\x20-]?[0-9]){12,14}(?![\w-])"),
}

#: Fixed values of the gazetteers and cues.
TOP_DOMAINS = frozenset("com org net edu gov info io co de fr es it uk eu us ch at be nl pt".split())
COUNTRY_CALLS = frozenset("1 7 20 27 30 31 32 33 34 39 40 41 43 44 45 46 47 48 49 52 54 55 61 81 82 86 90 91 351 353 358".split())
IBAN_COUNTRIES = frozenset("AT BE CH DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split())
CARD_STARTS = ("2", "34", "36", "37", "38", "4", "5", "6")
CUES = {
    "email": "mail contact write correo courriel kontakt",
    "ip": "ip address host server client adresse dirección",
    "card": "card visa credit carte karte tarjeta pay",
    "phone": "tel phone call fax mobile telefon téléphone teléfono",
    "ssn": "ssn social security tax",
    "iban": "iban account bank konto compte cuenta",
}
_CUE = {k: re.compile("|".join(v.split())) for k, v in CUES.items()}
_CUE_OF = {
    "phone_local": "phone", "card_short": "card", "email_spoken": "email",
    **{k: k for k in ("email", "ip", "card", "phone", "ssn", "iban")},
}


def _emails(t: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses: the run before each @, then the longest domain after it."""
    done, at = 0, t.find("@")
    while at >= 0:
        begin = at
        while begin > done and t[begin - 1] in _LOCAL_CLASS:
            begin -= 1
        m = _DOMAIN.match(t, at + 1) if begin < at else None
        if m:
            yield begin, m.end()
            done = m.end()
        at = t.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(t: str) -> list[tuple[str, int, int]]:
    """Spans of the four fixed kinds, by kind, then start."""
    found = [("email", b, e) for b, e in _emails(t)] if "@" in t else []
    if not _DIGIT.search(t):
        return found
    for m in _IP.finditer(t):
        if all(map(_small, m[0].split("."))):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(t):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in t:
        for m in _PHONE.finditer(t):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


def more_spans(t: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Proposed spans of the looser kinds that touch no fixed span and no earlier proposal."""
    if not _DIGIT.search(t) and "at" not in t:
        return []
    found: list[tuple[str, int, int]] = []
    for kind, pattern in _MORE.items():
        if kind == "email_spoken" and "(at)" not in t and "[at]" not in t:
            continue
        taken = Taken((b, e) for _, b, e in [*base, *found])
        found += [(kind, m.start(), m.end()) for m in pattern.finditer(t) if not taken.meets(m.start(), m.end())]
    return found


def iban_valid(value: str) -> bool:
    value = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def votes(t: str, kind: str, begin: int, end: int) -> tuple[int, ...]:
    """One vote per labeler: personal data, clean, or abstain."""
    value = t[begin:end]
    digits = "".join(c for c in value if "0" <= c <= "9")
    form = gazetteer = ABSTAIN
    if kind in ("email", "email_spoken"):
        last = re.split(r"[.\s\])]+", value)[-1].lower()
        form = PII if last.isalpha() and len(last) >= 2 else CLEAN
        gazetteer = PII if last in TOP_DOMAINS else ABSTAIN
    elif kind == "ip":
        parts = value.split(".")
        form = CLEAN if any(len(p) > 1 and p[0] == "0" for p in parts) else PII
        gazetteer = CLEAN if parts[0] in ("0", "127", "255") else ABSTAIN
    elif kind in ("card", "card_short"):
        form = PII if luhn(digits) else CLEAN
        gazetteer = PII if digits.startswith(CARD_STARTS) else CLEAN
    elif kind == "phone":
        form = PII if 10 <= len(digits) <= 13 else ABSTAIN
        gazetteer = PII if any(digits[:n] in COUNTRY_CALLS for n in (1, 2, 3)) else CLEAN
    elif kind == "phone_local":
        form = PII if digits[0] not in "01" and digits[3] not in "01" else CLEAN
        gazetteer = PII if value[0] == "(" else ABSTAIN
    elif kind == "ssn":
        form = CLEAN if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000" else PII
    elif kind == "iban":
        form = PII if iban_valid(value) else CLEAN
        gazetteer = PII if value[:2] in IBAN_COUNTRIES else CLEAN
    cue = PII if _CUE[_CUE_OF[kind]].search(t[max(0, begin - 40) : begin].lower()) else ABSTAIN
    before, after = t[begin - 1 : begin], t[end : end + 1]
    glued = before.isalnum() or after.isalnum() or (after == "." and t[end + 1 : end + 2].isdigit())
    neighbours = CLEAN if glued and kind != "email" else ABSTAIN
    variety = CLEAN if digits and len(set(digits)) == 1 else PII if len(set(digits)) >= 4 else ABSTAIN
    return form, gazetteer, cue, neighbours, variety


def code_of(kind: str, cast: tuple[int, ...]) -> int:
    """Kind and votes as one small number."""
    code = KINDS.index(kind)
    for v in cast:
        code = code * 3 + v + 1
    return code


def decode(code: int) -> tuple[str, tuple[int, ...]]:
    cast = []
    for _ in LABELERS:
        code, v = divmod(code, 3)
        cast.append(v - 1)
    return KINDS[code], tuple(reversed(cast))


def join_spans(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{b}:{e}" for k, b, e in spans)


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """Fixed spans and proposed spans with the votes on each; other columns of ``docs`` but the text stay."""
    kept, schema = extended(
        docs,
        "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base_spans string, "
        "base_codes array<int>, more array<struct<span: string, code: int>>",
        drop=text,
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        more_type = pa.list_(pa.struct([("span", pa.string()), ("code", pa.int32())]))
        for batch in slices(batches, text):
            out: list[list] = [[] for _ in range(8)]
            for t in batch.column(text).to_pylist():
                t = t or ""
                base = base_spans(t)
                joined = join_spans(base)
                row = [sum(s[0] == k for s in base) for k in BASE_KINDS]
                row += [hashlib.sha256(joined.encode()).hexdigest(), joined]
                row.append([code_of(k, votes(t, k, b, e)) for k, b, e in base])
                more = more_spans(t, base)
                row.append([{"span": f"{k}:{b}:{e}", "code": code_of(k, votes(t, k, b, e))} for k, b, e in more])
                for o, v in zip(out, row):
                    o.append(v)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.list_(pa.int32()), more_type]
            arrays = [batch.column(c) for c in kept] + [pa.array(o, k) for o, k in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.select(*kept, text).mapInArrow(search, schema)


def reliabilities(patterns: list[tuple[tuple[int, ...], float]], rounds: int = 50):
    """Expectation-maximisation: share of personal data, and per labeler how often its votes are right.

    A labeler is taken to be right in 0.55 to 0.99 of its votes. Without spans the start values come back.
    """
    prior, right = START_PRIOR, [START_RIGHT] * len(LABELERS)
    if not patterns:
        return prior, right
    for _ in range(rounds):
        hits, cast, positive, total = np.full(len(LABELERS), 1.6), np.full(len(LABELERS), 2.0), 0.5, 1.0
        for v, n in patterns:
            p = posterior(v, prior, right)
            positive, total = positive + n * p, total + n
            for j, x in enumerate(v):
                if x != ABSTAIN:
                    hits[j] += n * (p if x == PII else 1 - p)
                    cast[j] += n
        prior = float(np.clip(positive / total, 0.05, 0.95))
        right = np.clip(hits / cast, 0.55, 0.99).tolist()
    return prior, right


def posterior(cast: tuple[int, ...], prior: float, right: list[float]) -> float:
    x = np.log(prior / (1 - prior))
    for v, r in zip(cast, right):
        x += 0 if v == ABSTAIN else np.log(r / (1 - r)) * (1 if v == PII else -1)
    return float(1 / (1 + np.exp(-x)))


def _features(kind: str, cast: tuple[int, ...]) -> np.ndarray:
    """One input per kind and per (labeler, vote)."""
    x = np.zeros(len(KINDS) + 2 * len(LABELERS))
    x[KINDS.index(kind)] = 1
    for j, v in enumerate(cast):
        if v != ABSTAIN:
            x[len(KINDS) + 2 * j + v] = 1
    return x


def train(counts: dict[int, int], rounds: int = 400) -> set[int]:
    """Codes that the span classifier accepts: logistic regression on the posteriors, weighted by count."""
    rows = [(decode(c), n) for c, n in sorted(counts.items())]
    if not rows:
        return set()
    prior, right = reliabilities([(v, n) for (_, v), n in rows])
    x = np.stack([_features(k, v) for (k, v), _ in rows])
    y = np.array([posterior(v, prior, right) for (_, v), _ in rows])
    n = np.sqrt(np.array([n for _, n in rows], float))
    w, b = np.zeros(x.shape[1]), 0.0
    for _ in range(rounds):
        gap = n * (1 / (1 + np.exp(-(x @ w + b))) - y) / n.sum()
        w -= 2.0 * (x.T @ gap + 1e-4 * w)
        b -= 2.0 * gap.sum()
    p = 1 / (1 + np.exp(-(x @ w + b)))
    return {code_of(k, v) for ((k, v), _), q in zip(rows, p) if q >= ACCEPT}


def annotate(docs: DataFrame, text: str = "text") -> DataFrame:
    """Counts and digest of the fixed spans, and all spans with those the classifier adds."""
    found = written(find(docs, text), "pii")
    codes = found.select(F.explode(F.concat("base_codes", F.transform("more", lambda m: m["code"]))).alias("code"))
    accepted = train({r["code"]: r["count"] for r in codes.groupBy("code").count().collect()})
    good = F.array(*map(F.lit, sorted(accepted))) if accepted else F.array().cast("array<int>")
    added = F.transform(F.filter("more", lambda m: F.array_contains(good, m["code"])), lambda m: m["span"])
    both = F.concat(F.when(F.col("base_spans") == "", F.array().cast("array<string>")).otherwise(F.array("base_spans")), added)
    return found.withColumns({"spans": F.array_join(both, ","), "n_added": F.size(added).cast("long")}).drop(
        "base_spans", "base_codes", "more"
    )


def redact(t: str, spans: str) -> str:
    """The text with every span of the joined form replaced by its kind in brackets."""
    parts = [s.split(":") for s in spans.split(",") if s]
    for kind, b, e in sorted(parts, key=lambda p: -int(p[1])):
        t = t[: int(b)] + f"[{kind}]" + t[int(e) :]
    return t
