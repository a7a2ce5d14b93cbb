"""Personal data by patterns and a semi-Markov conditional random field.

The field scores whole candidate segments of tokens by features of the span, and dynamic programming over
segments of bounded length chooses boundaries and types together. It learns from the places that the base
patterns find in a bounded sample of windows, drawn by kind from all texts, and finds further ones that they miss.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import map_rows, spans_text
from tidegate.workspace import stage

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

# The base patterns. Those that could start anywhere in a long run start at its beginning.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
DIGITS = re.compile(r"[0-9]([\x20-]?[0-9])+")
CALL = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HINT = re.compile(r"[0-9@]")

TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|.", re.DOTALL)
SPACE = frozenset(" \t\n\r\x0b\x0c")
# Tokens of the longest segment.
REACH = 24
# The sample: windows with each kind, windows without any that look like one (so many digits or an @) and others;
# how many of each a text gives, and the tokens of a window that the field learns from; then the steps and their size.
SAMPLE, HARD_DIGITS = (40, 40, 40, 40, 80, 80), 7
QUOTA, WINDOW_TOKENS = 3, 60
STEPS, RATE, SHRINK = 60, 0.3, 0.01

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the base patterns, leftmost and not overlapping within a kind."""
    found: list[Span] = []
    if not HINT.search(text):
        return found
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, EMAIL, domain.end()))
            last = domain.end()
        at = text.find("@", max(at + 1, last))
    for m in ADDRESS.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), IP, m.end()))
    for m in DIGITS.finditer(text):
        digits = only_digits(m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), CARD, m.end()))
    for m in CALL.finditer(text):
        if 9 <= len(only_digits(m[0])) <= 15:
            found.append((m.start(), PHONE, m.end()))
    return sorted(found)


def windows(text: str) -> list[tuple[int, int]]:
    """Stretches of words with a digit or an @, single spaces between them; nothing is found outside them."""
    found: list[tuple[int, int]] = []
    end = 0
    for m in HINT.finditer(text):
        if m.start() < end:
            continue
        start = m.start()
        while start > end and text[start - 1] not in SPACE:
            start -= 1
        end = m.end()
        while end < len(text) and text[end] not in SPACE:
            end += 1
        if found and start == found[-1][1] + 1 and text[start - 1] == " ":
            found[-1] = (found[-1][0], end)
        else:
            found.append((start, end))
    return found


PLAIN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789@._%+()- ")
DIALLED = frozenset("0123456789 ().-+")
FEATURES = 27


def features(span: str, before: str, after: str, tokens: int) -> list[int]:
    """The features of a whole span that hold, given the characters around it."""
    digits = only_digits(span)
    n = len(digits)
    at = span.count("@")
    letters = any(c.isalpha() for c in span)
    spaced = " " in span
    numeric = not letters and all(c in "0123456789 -" for c in span)
    parts = span.split(".")
    quad = len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts)
    small = quad and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    clean = not ((before.isalnum() or before in tuple("._-@+/=")) if before else False) and not (
        (after.isalnum() or after in tuple("-@/=")) if after else False
    )
    mail = at == 1 and "." in span[span.index("@") :] and not spaced and span[0] != "@" and not span.endswith("@")
    plus = span[0] == "+" and span.count("+") == 1
    dialled = all(c in DIALLED for c in span)
    card = numeric and 12 <= n <= 19 and luhn(digits)
    holds = (
        True,
        at == 1,
        mail,
        plus,
        dialled,
        9 <= n <= 15,
        12 <= n <= 19,
        card,
        quad,
        small,
        numeric,
        letters,
        spaced,
        "(" in span,
        not clean,
        tokens == 1,
        tokens <= 6,
        tokens > 12,
        span.count("(") != span.count(")"),
        any(c not in PLAIN for c in span),
        n == 0,
        plus and dialled and 9 <= n <= 15,
        plus and dialled and 9 <= n <= 15 and clean,
        card and clean,
        small and clean,
        mail and clean,
        dialled and n == 10 and span.count("-") + span.count("(") >= 1 and clean,
    )
    return [i for i, held in enumerate(holds) if held]


@dataclass
class Lattice:
    """The candidate segments of a window: first token, end token and features of each."""

    tokens: list[tuple[int, int]]
    starts: np.ndarray
    ends: np.ndarray
    held: list[list[int]]

    def matrix(self) -> np.ndarray:
        matrix = np.zeros((len(self.held), FEATURES))
        for row, held in zip(matrix, self.held, strict=True):
            row[held] = 1
        return matrix


def lattice(text: str, start: int, end: int) -> Lattice:
    tokens = [m.span() for m in TOKEN.finditer(text, start, end)]
    starts, ends, held = [], [], []
    for i, (a, _) in enumerate(tokens):
        if text[a] in " .-)":
            continue
        hinted = False
        for j in range(i, min(len(tokens), i + REACH)):
            x, b = tokens[j]
            hinted = hinted or text[x] == "@" or "0" <= text[x] <= "9"
            if not hinted or not text[x].isalnum():
                continue
            starts.append(i)
            ends.append(j + 1)
            held.append(features(text[a:b], text[a - 1] if a else "", text[b] if b < len(text) else "", j + 1 - i))
    return Lattice(tokens, np.array(starts, int), np.array(ends, int), held)


class Field:
    """A semi-Markov conditional random field over segments; tokens outside segments score 0."""

    def __init__(self, weights: np.ndarray) -> None:
        self.weights = weights

    def find(self, text: str) -> list[Span]:
        """The best segments of each window of a text as (start, kind, end)."""
        found: list[Span] = []
        for start, end in windows(text):
            grid = lattice(text, start, end)
            if not grid.held:
                continue
            scores = np.array([self.weights[:, held].sum(axis=1) for held in grid.held])
            kinds, tops = scores.argmax(axis=1), scores.max(axis=1)
            useful = np.flatnonzero(tops > 0)
            ending: dict[int, list[int]] = {}
            for s in useful.tolist():
                ending.setdefault(int(grid.ends[s]), []).append(s)
            best = [0.0] * (len(grid.tokens) + 1)
            chosen = [-1] * (len(grid.tokens) + 1)
            for j in range(1, len(best)):
                best[j] = best[j - 1]
                for s in ending.get(j, ()):
                    total = best[int(grid.starts[s])] + float(tops[s])
                    if total > best[j]:
                        best[j], chosen[j] = total, s
            j = len(grid.tokens)
            while j > 0:
                s = chosen[j]
                if s < 0:
                    j -= 1
                    continue
                first = int(grid.starts[s])
                found.append((grid.tokens[first][0], int(kinds[s]), grid.tokens[j - 1][1]))
                j = first
        return sorted(found)


def learn(examples: list[tuple[str, int, int]]) -> Field:
    """Weights of the greatest conditional likelihood, less a shrinking term, of windows (text, start, end) whose
    segments are the base spans."""
    weights = np.zeros((len(KINDS), FEATURES))
    problems = []
    for text, start, end in examples:
        grid = lattice(text, start, end)
        if not grid.held or len(grid.tokens) > WINDOW_TOKENS:
            continue
        gold = np.zeros((len(grid.held), len(KINDS)))
        places = {(grid.tokens[i][0], grid.tokens[j - 1][1]): s for s, (i, j) in enumerate(zip(grid.starts, grid.ends, strict=True))}
        reached = 0
        for a, kind, b in base_spans(text):
            if a >= max(start, reached) and b <= end and (a, b) in places:
                gold[places[a, b], kind] = 1
                reached = b
        problems.append((grid, grid.matrix(), gold))
    if not any(gold.any() for _, _, gold in problems):
        return Field(weights)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):
        slope = -SHRINK * weights
        for grid, matrix, gold in problems:
            slope += (gold - _expected(grid, matrix @ weights.T)).T @ matrix / len(problems)
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope * slope
        weights = weights + RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Field(weights)


def _expected(grid: Lattice, scores: np.ndarray) -> np.ndarray:
    """Probability of each segment and kind, by sums over all segmentations from the left and from the right."""
    n = len(grid.tokens)
    of = np.logaddexp.reduce(scores, axis=1)
    left, right = np.zeros(n + 1), np.zeros(n + 1)
    by_end = [np.flatnonzero(grid.ends == j) for j in range(n + 1)]
    by_start = [np.flatnonzero(grid.starts == i) for i in range(n + 1)]
    for j in range(1, n + 1):
        into = by_end[j]
        left[j] = np.logaddexp.reduce([left[j - 1], *(left[grid.starts[into]] + of[into])])
    for i in range(n - 1, -1, -1):
        out = by_start[i]
        right[i] = np.logaddexp.reduce([right[i + 1], *(right[grid.ends[out]] + of[out])])
    return np.exp(scores + (left[grid.starts] + right[grid.ends] - left[n])[:, None])


def sample(text: str | None) -> list[tuple[int, str, int, int]]:
    """At most QUOTA windows of each part of SAMPLE as (part, text, start, end), with the characters around them."""
    found: list[tuple[int, str, int, int]] = []
    taken = [0] * len(SAMPLE)
    for s, e in windows(text or ""):
        if e - s > 8 * WINDOW_TOKENS or min(taken) >= QUOTA:
            continue
        cut, start = text[max(0, s - 1) : e + 1], min(s, 1)
        end = start + e - s
        if sum(1 for _ in TOKEN.finditer(cut, start, end)) > WINDOW_TOKENS:
            continue
        parts = {kind for a, kind, b in base_spans(cut) if start <= a and b <= end}
        hard = "@" in cut or len(only_digits(cut)) >= HARD_DIGITS
        for part in parts or {len(KINDS) if hard else len(KINDS) + 1}:
            if taken[part] < QUOTA:
                taken[part] += 1
                found.append((part, cut, start, end))
    return found


def train(df: DataFrame, key: str = "doc_id", text: str = "text") -> Field:
    """A field learned from windows of all texts: distinct ones of least hash, as many of each part as SAMPLE says."""
    hinted = df.where(F.col(text).rlike("[0-9@]"))

    def make():
        return lambda value: (sample(value),)

    schema = "w array<struct<part:int,cut:string,start:int,end:int>>"
    drawn = map_rows(hinted, [text], schema, make).select(F.inline("w")).distinct()
    drawn = stage(drawn, "windows").df
    order = [F.xxhash64("cut"), "cut", "start", "end"]
    found = []
    for part, most in enumerate(SAMPLE):
        found += [r[1:] for r in drawn.where(F.col("part") == part).orderBy(*order).limit(most).collect()]
    return learn(sorted(set(found)))


def scan(
    df: DataFrame, field: Field | None = None, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Personal data of each text: the ``keep`` columns, n_email, n_ip, n_card, n_phone, base_sha256 and spans.

    ``spans`` holds the base spans and those segments of the field that overlap none of them, as
    ``kind:start:end`` in characters. Without a ``field`` one is trained on ``df``.

    A NULL or empty text has none. Texts are read whole; the time for a window grows with its length times the
    longest segment. Repeated rows give repeated results, an empty table an empty one. Where the base patterns
    find nothing in any text the field finds nothing. Other columns are ignored.
    """
    weights = (field or train(df, key, text)).weights

    def make():
        finder = Field(weights)

        def one(value, *kept):
            value = value or ""
            base = base_spans(value)
            more = []
            for start, kind, end in finder.find(value):
                if all(end <= a or start >= b for a, _, b in base):
                    more.append((start, kind, end))
            counts = [sum(kind == k for _, kind, _ in base) for k in range(len(KINDS))]
            digest = hashlib.sha256(spans_text(base, KINDS).encode()).hexdigest()
            return (*kept, *counts, digest, spans_text(base + more, KINDS))

        return one

    kept = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    schema = f"{kept}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return map_rows(df, [text, *keep], schema, make)
