"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors (at-signs, digits before dots, plus signs, digits, schemes and
identifier cues).  From each anchor a deterministic parser reads outwards to the span's borders, and
validates it.  Of kinds email, ip, card and phone these are the leftmost non-overlapping matches of

    email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+
    ip     [0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)       parts at most 255
    card   [0-9]([\\x20-]?[0-9])+                       14 to 19 digits passing Luhn
    phone  \\+[0-9][\\x20().0-9-]+[0-9]                  10 to 15 digits

of which those that fail are dropped without another try.  Further kinds: url (after a scheme), key
(access keys with a fixed head) and secret (a value that a cue such as password or token names).

Edge cases: a null or empty text has no spans; offsets are code points; rows are answered one by one,
so repeated rows repeat; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from daystack.llm.common import texts

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "key", "secret")

Span = tuple[str, int, int]

# ---------------------------------------------------------------- anchors

#: Schemes, heads of access keys, and words that name a secret value.
SCHEMES = ("http://", "https://", "ftp://", "mailto:", "tel:", "www.")
KEY_HEADS = ("AKIA", "ASIA", "ghp_", "xoxb-", "sk_live_")
CUES = ("password", "passwd", "secret", "token", "api_key", "apikey", "iban", "account")


def anchors() -> dict[str, tuple[str, ...]]:
    """Anchor -> kinds of span that it may be in."""
    out = {"@": ("email",), "+": ("phone",)}
    out |= {f"{d}.": ("ip",) for d in range(10)}
    out |= {f"{a}{b}": ("card",) for a in range(10) for b in range(10)}
    out |= {f"{a}{s}{b}": ("card",) for a in range(10) for b in range(10) for s in " -"}
    out |= {s: ("url",) for s in SCHEMES} | {s: ("key",) for s in KEY_HEADS}
    return out | {form: ("secret",) for c in CUES for form in (c, c.upper(), c.capitalize())}


_automaton = None


def automaton():
    global _automaton
    if _automaton is None:
        import ahocorasick

        _automaton = ahocorasick.Automaton()
        for word, kinds in anchors().items():
            _automaton.add_word(word, (len(word), kinds))
        _automaton.make_automaton()
    return _automaton


# ---------------------------------------------------------------- parsers

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = frozenset("0123456789")
_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_quad = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_run = re.compile(r"[0-9](?:[ -]?[0-9])+")
_call = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_rest = re.compile(r"[^\s<>\"'{}|\\^`]+")
_key = re.compile(r"[A-Za-z0-9_-]{16,}")
_value = re.compile(r"\s?(?:=|:|is)\s?[\"']?([A-Za-z0-9+/_.-]{8,})[\"']?")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


# A parser gets the text, the anchor's start and the end of the kind's last match (kept or dropped),
# and returns the match's start and end and whether it stands, or None where the pattern has no match.
Match = tuple[int, int, bool] | None


def email(text: str, at: int, free: int) -> Match:
    start = at
    while start > free and text[start - 1] in LOCAL:
        start -= 1
    if start == at or not (m := _domain.match(text, at + 1)):
        return None
    return start, m.end(), True


def _digits_left(text: str, at: int, free: int) -> int:
    while at > free and text[at - 1] in DIGITS:
        at -= 1
    return at


def ip(text: str, at: int, free: int) -> Match:
    start = _digits_left(text, at, free)
    if not (m := _quad.match(text, start)):
        return None
    parts = m.group().split(".")
    return start, m.end(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def card(text: str, at: int, free: int) -> Match:
    m = _run.match(text, at)  # the first anchor after the last match is at the run's start
    digits = m.group().replace(" ", "").replace("-", "")
    return at, m.end(), 14 <= len(digits) <= 19 and luhn(digits)


def phone(text: str, at: int, free: int) -> Match:
    if not (m := _call.match(text, at)):
        return None
    n = sum(c in DIGITS for c in m.group())
    return at, m.end(), 10 <= n <= 15


def url(text: str, at: int, free: int) -> Match:
    if at and text[at - 1].isalnum() or not (m := _rest.match(text, at)):
        return None
    end = at + len(m.group().rstrip(".,;:!?)*"))
    scheme = next(s for s in SCHEMES if text.startswith(s, at))
    return (at, end, True) if end - at > len(scheme) else None


def key(text: str, at: int, free: int) -> Match:
    if at and text[at - 1].isalnum() or not (m := _key.match(text, at)):
        return None
    return at, m.end(), any(c in DIGITS for c in m.group())


def secret(text: str, at: int, free: int) -> Match:
    end = at
    while end < len(text) and (text[end].isalpha() or text[end] == "_"):
        end += 1
    if not (m := _value.match(text, end)):
        return None
    return m.start(1), m.end(1), any(c in DIGITS for c in m.group(1))


PARSERS: dict[str, Callable[[str, int, int], Match]] = {"email": email, "ip": ip, "card": card, "phone": phone, "url": url, "key": key, "secret": secret}


def find_spans(text: str) -> list[Span]:
    """All spans of a text, by start, then kind."""
    free = dict.fromkeys(KINDS, 0)
    out: list[Span] = []
    for last, (length, kinds) in automaton().iter(text):
        at = last + 1 - length
        for kind in kinds:
            if at < free[kind]:
                continue
            if m := PARSERS[kind](text, at, free[kind]):
                free[kind] = m[1]
                if m[2]:
                    out.append((kind, m[0], m[1]))
    order = {k: n for n, k in enumerate(KINDS)}
    return sorted(out, key=lambda s: (s[1], order[s[0]]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


# ---------------------------------------------------------------- operators


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per span: doc_id, kind, start, end, value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, k, s, e, t[s:e]) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for k, s, e in find_spans(t)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["doc_id", "kind", "start", "end", "value"])

    return texts(docs).mapInArrow(run, "doc_id long, kind string, start long, end long, value string")


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, a digest of their spans, and all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [find_spans(t) for t in b.column(1).to_pylist()]
            counts = [pa.array([sum(s[0] == k for s in spans) for spans in found], pa.int64()) for k in BASE]
            digests = [hashlib.sha256(joined([s for s in spans if s[0] in BASE]).encode()).hexdigest() for spans in found]
            yield pa.RecordBatch.from_arrays([b.column(0), *counts, pa.array(digests, pa.string()), pa.array(map(joined, found), pa.string())], ["doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans"])

    return texts(docs).mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(docs: DataFrame) -> DataFrame:
    """doc_id and its text with each span's kind in angle brackets in its place; of overlapping spans the first."""

    def mask(text: str) -> str:
        out, at = [], 0
        for kind, start, end in find_spans(text):
            if start >= at:
                out += [text[at:start], f"<{kind}>"]
                at = end
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(mask, b.column(1).to_pylist()), pa.string())], ["doc_id", "text"])

    return texts(docs).mapInArrow(run, "doc_id long, text string")
