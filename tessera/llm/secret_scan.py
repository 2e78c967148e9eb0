"""Secrets in text: fixed patterns, and strings of high entropy.

Three fixed kinds (assign, access, hex) are found by their patterns and always reported. Beyond them,
candidate strings are runs of characters that keys are written in. A window slides over each candidate;
counts per character are updated as one character enters and one leaves, so the Shannon entropy of every
window comes from one addition and one subtraction. Each character class has its own limit. Strings that
an allow-list knows as harmless are suppressed.

Null text is empty. Every row is searched by itself: repeated rows, null ids and extra columns make no
difference, and an empty table gives an empty result. All scans are linear in the text.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import Taken, extended, slices

BASE_KINDS = ["assign", "access", "hex"]
WINDOW = 20

#: Entropy in bits per character that some window must reach, by the class of the candidate's characters.
LIMITS = {"hex": 3.0, "lower": 3.6, "mixed": 3.8}

_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)
_KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")

#: A part of a path that looks like words: in one case, capitalised or in humps; digits only after a word or by themselves.
_HUMPS = r"(?:[A-Z]?[a-z]+|[A-Z]+|(?:[A-Z]?[a-z]{2,})(?:[A-Z][a-z]{2,})+)"
_SEGMENT = re.compile(rf"(?:{_HUMPS}[0-9]{{0,4}}|[0-9]{{1,8}})?(?:[-_=+]+(?:{_HUMPS}[0-9]{{0,4}}|[0-9]{{1,8}}))*[-_=+]*")

#: Harmless strings, as whole candidates: fixed values.
ALLOWED = [
    r"[0-9_=+/-]+",
    r"(?i:[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})",
    r"(?i:.*(?:example|sample|dummy|placeholder|lorem|xxxx).*)",
    r"[A-Za-z]+(?:[-_/][A-Za-z]+)+[-_/]?[0-9]{1,8}",
]
_ALLOWED = re.compile("|".join(f"(?:{a})" for a in ALLOWED))


def window_entropies(s: str, width: int = WINDOW) -> Iterator[float]:
    """Shannon entropy of each window: log2 w - (sum of c log2 c) / w, kept up to date by counts."""
    width = min(width, len(s))
    if not width:
        return
    part = [0.0] + [c * math.log2(c) for c in range(1, width + 1)]
    counts: dict[str, int] = {}
    total = 0.0
    for i, c in enumerate(s):
        n = counts.get(c, 0)
        total += part[n + 1] - part[n] if n < width else 0.0
        counts[c] = n + 1
        if i >= width:
            out = s[i - width]
            n = counts[out]
            total += part[n - 1] - part[n] if n <= width else 0.0
            counts[out] = n - 1
        if i >= width - 1:
            yield math.log2(width) - total / width


def class_of(s: str) -> str:
    if all(c in "0123456789abcdef-" for c in s) or all(c in "0123456789ABCDEF-" for c in s):
        return "hex"
    return "lower" if s.lower() == s or s.upper() == s else "mixed"


def is_path(s: str) -> bool:
    """Five or more parts between slashes, all of words and none a secret by itself.

    The slash is a character of keys too, so their number alone says nothing.
    """
    parts = s.split("/")
    return len(parts) > 4 and all(_SEGMENT.fullmatch(p) for p in parts) and not any(is_secret(p) for p in parts)


#: Letters per part between changes of case, below which a string of letters in both cases is not made of words.
WORD_PART = 3.0
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[A-Z]")


def is_words(s: str) -> bool:
    """A string without digits that looks like words: in one case, or in both with parts as long as words have."""
    if any(c.isdigit() for c in s):
        return False
    letters = [c for c in s if c.isalpha()]
    if not letters or s.lower() == s or s.upper() == s:
        return True
    return len(letters) / len(_PARTS.findall(s)) >= WORD_PART


def is_secret(s: str) -> bool:
    """Some window reaches the limit of the string's class; no allow-list entry holds the string, it is no path and no words."""
    if _ALLOWED.fullmatch(s) or is_words(s) or is_path(s):
        return False
    limit = LIMITS[class_of(s)]
    return any(h >= limit for h in window_entropies(s))


def base_spans(t: str) -> list[tuple[str, int, int]]:
    """Spans of the three fixed kinds, by start, then kind."""
    found = []
    low = t.lower()
    if any(k in low for k in _KEYWORDS):
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(t) if len(m[2]) >= 6]
    if "AKIA" in t:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(t) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(t)]
    return sorted(found, key=_order)


def _order(span: tuple[str, int, int]) -> tuple[int, int]:
    return span[1], (BASE_KINDS + ["entropy"]).index(span[0])


def all_spans(t: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Fixed spans, and fixed spans with the high-entropy strings that touch none of them."""
    base = base_spans(t)
    taken = Taken((b, e) for _, b, e in base)
    added = [
        ("entropy", m.start(), m.end())
        for m in _CANDIDATE.finditer(t)
        if not taken.meets(m.start(), m.end()) and is_secret(m[0])
    ]
    return base, sorted(base + added, key=_order) if added else base


def join_spans(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{b}:{e}" for k, b, e in spans)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Counts and digest of the fixed spans and all spans; other columns of ``docs`` but the text stay."""
    kept, schema = extended(
        docs,
        "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long",
        drop=text,
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            out: list[list] = [[] for _ in range(6)]
            for t in batch.column(text).to_pylist():
                base, spans = all_spans(t or "")
                row = [sum(s[0] == k for s in base) for k in BASE_KINDS]
                row += [hashlib.sha256(join_spans(base).encode()).hexdigest(), join_spans(spans), len(spans) - len(base)]
                for o, v in zip(out, row):
                    o.append(v)
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            arrays = [batch.column(c) for c in kept] + [pa.array(o, k) for o, k in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.select(*kept, text).mapInArrow(search, schema)
