"""Personal data: fixed patterns plus spans from a semi-Markov conditional random field.

The patterns of ``base_spans`` always stand. Beside them a semi-Markov CRF reads every stretch
of tokens that a segment around a digit or an at sign no pattern has covered can reach. Candidate segments of up to
``LONGEST`` tokens get a score from features of the whole span (its shape, its number of
digits, check sum, dotted quad, address form, neighbours); a dynamic programme over the bounded
segments then chooses boundaries and types together. Stretches are cut where no segment can
reach across, so the programme is exact and its memory is bounded by the stretch.

The model is trained here by maximum likelihood (forward-backward over segments): the stretches
of at most ``train_docs`` documents labelled by the patterns, and written-out forms the patterns
miss, with look-alikes that are none (dates, versions, amounts, failing check sums).

Defined cases: null and empty texts have no spans. Spans count code points, end exclusive. They
are ordered by start, then by kind as listed in ``KINDS``.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isotherm.llm.common import drawn

KINDS = ("email", "ip", "card", "phone")
LONGEST = 16
Span = tuple[int, int, str]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match never starts inside a run of digits: the run's start would have matched as well
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\s+|[^\s]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _octet(part: str) -> bool:
    part = part.lstrip("0") or "0"
    return len(part) <= 3 and int(part) <= 255


def _emails(text: str) -> Iterator[Span]:
    """Every at sign decides once for the whole run of local characters before it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end(), "email"
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[Span]:
    """The pattern spans of all kinds, leftmost and non-overlapping within a kind."""
    if not _MARK.search(text):
        return []
    found = list(_emails(text))
    found += [(*m.span(), "ip") for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append((*m.span(), "card"))
    if "+" in text:
        found += [(*m.span(), "phone") for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


# ---- features of a whole span -------------------------------------------------------------


def _beside(c: str) -> str:
    if not c:
        return "edge"
    return "space" if c.isspace() else "digit" if c.isdigit() else "letter" if c.isalpha() else c


def features(text: str, start: int, end: int) -> list[str]:
    s = text[start:end]
    digits = _digits(s)
    shape = re.sub(r"[0-9]+", "9", re.sub(r"[^\W\d_]+", "a", s))[:20]
    out = [
        "bias",
        f"shape={shape}",
        f"n={min(len(digits), 20)}",
        f"left={_beside(text[start - 1 : start])}",
        f"right={_beside(text[end : end + 1])}",
        f"runs={','.join(str(len(r)) for r in re.findall('[0-9]+', s)[:6])}" if "@" not in s else "at",
    ]
    if len(digits) >= 12:
        out += [f"luhn={luhn(digits)}", f"luhn={luhn(digits)} {out[-1]}"]
    if "@" not in s:
        out.append(f"words={'a' in shape} {out[5]}")
    if any(c.isspace() for c in s):
        out.append(f"dense={''.join(shape.split())}")
    if shape == "9.9.9.9":
        out.append(f"quad={all(map(_octet, s.split('.')))}")
    if "@" in s:
        local, _, domain = s.partition("@")
        out.append(f"address={bool(local) and bool(_DOMAIN.fullmatch(domain))}")
        out.append(f"clean={all(c in _LOCAL for c in local)}")
    return out


def segments(text: str, bounds: list[int]) -> list[tuple[int, int, list[str]]]:
    """Candidate segments as token positions: no white space at the ends, four digits or an at
    sign inside."""
    out, n = [], len(bounds) - 1
    tokens = [text[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
    marks, blank = [0], [t.isspace() for t in tokens]
    for t in tokens:  # an at sign counts as four digits
        marks.append(marks[-1] + (4 if t == "@" else len(_digits(t))))
    for i in range(n):
        if blank[i]:
            continue
        for j in range(i + 1, min(n, i + LONGEST) + 1):
            if not blank[j - 1] and marks[j] - marks[i] >= 4:
                out.append((i, j, features(text, bounds[i], bounds[j])))
    return out


def _bounds(text: str, start: int, end: int) -> list[int]:
    return [start, *(m.end() for m in _TOKEN.finditer(text, start, end))]


def _add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


Weights = dict[str, tuple[float, ...]]


def _score(weights: dict, found: list[str], kind: int) -> float:
    return sum(w[kind] for f in found if (w := weights.get(f)))


def decode(weights: Weights, text: str, start: int, end: int) -> list[Span]:
    """The best segmentation of one stretch; a token outside any segment scores nothing."""
    bounds = _bounds(text, start, end)
    n = len(bounds) - 1
    best, back = [0.0] * (n + 1), [None] * (n + 1)
    ending: list[list] = [[] for _ in range(n + 1)]
    for i, j, found in segments(text, bounds):
        scores = [_score(weights, found, k) for k in range(len(KINDS))]
        k = max(range(len(KINDS)), key=scores.__getitem__)
        ending[j].append((i, scores[k], k))
    for j in range(1, n + 1):
        best[j], back[j] = best[j - 1], None
        for i, s, k in ending[j]:
            if best[i] + s > best[j]:
                best[j], back[j] = best[i] + s, (i, k)
    spans, j = [], n
    while j:
        if back[j] is None:
            j -= 1
        else:
            i, k = back[j]
            spans.append((bounds[i], bounds[j], KINDS[k]))
            j = i
    return spans[::-1]


def train(examples: list[tuple[str, list[Span]]], *, epochs: int = 4, rate: float = 0.4, decay: float = 1e-4) -> Weights:
    """Maximum likelihood by AdaGrad; an example is a stretch and its spans."""
    weights: dict[str, list[float]] = {}
    squares: dict[str, list[float]] = {}
    kinds = range(len(KINDS))
    ready = []
    for text, spans in examples:
        bounds = _bounds(text, 0, len(text))
        gold = {(s, e): KINDS.index(k) for s, e, k in spans}
        found = segments(text, bounds)
        hit = {(bounds[i], bounds[j]) for i, j, _ in found}
        if not set(gold) - hit:
            ready.append((len(bounds) - 1, [(i, j, f, gold.get((bounds[i], bounds[j]))) for i, j, f in found]))
    order = random.Random(7)
    for _ in range(epochs):
        order.shuffle(ready)
        for n, found in ready:
            scored = [(i, j, f, g, [_score(weights, f, k) for k in kinds]) for i, j, f, g in found]
            ahead, behind = [-math.inf] * (n + 1), [-math.inf] * (n + 1)
            ahead[0] = behind[n] = 0.0
            by_end, by_start = [[] for _ in range(n + 1)], [[] for _ in range(n + 1)]
            for x in scored:
                by_end[x[1]].append(x)
                by_start[x[0]].append(x)
            for j in range(1, n + 1):
                ahead[j] = ahead[j - 1]
                for i, _, _, _, s in by_end[j]:
                    for v in s:
                        ahead[j] = _add(ahead[j], ahead[i] + v)
            for i in range(n - 1, -1, -1):
                behind[i] = behind[i + 1]
                for _, j, _, _, s in by_start[i]:
                    for v in s:
                        behind[i] = _add(behind[i], behind[j] + v)
            for i, j, f, g, s in scored:
                for k in kinds:
                    slope = (g == k) - math.exp(min(0.0, ahead[i] + s[k] + behind[j] - ahead[n]))
                    if abs(slope) < 1e-4:
                        continue
                    for name in f:
                        w = weights.setdefault(name, [0.0] * len(KINDS))
                        q = squares.setdefault(name, [1e-2] * len(KINDS))
                        step = slope - decay * w[k]
                        q[k] += step * step
                        w[k] += rate * step / math.sqrt(q[k])
    return {f: tuple(w) for f, w in weights.items()}


def stretches(text: str, spans: list[Span]) -> Iterator[tuple[int, int]]:
    """Stretches outside the spans that hold all segments: the ``LONGEST`` - 1 tokens on either side of
    each digit or at sign, joined where they meet."""
    at = 0
    for s in [*spans, (len(text), len(text), "")]:
        if at < s[0] and _MARK.search(text, at, s[0]):
            bounds = _bounds(text, at, s[0])
            first = last = -1
            for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                if not _MARK.search(text, a, b):
                    continue
                if first >= 0 and i - LONGEST + 1 > last:
                    yield bounds[first], bounds[last]
                    first = -1
                if first < 0:
                    first = max(0, i - LONGEST + 1)
                last = min(len(bounds) - 1, i + LONGEST)
            yield bounds[first], bounds[last]
        at = max(at, s[1])


def find(text: str, weights: Weights) -> tuple[list[Span], list[Span]]:
    """Pattern spans, and those with what the model adds beside them."""
    base = base_spans(text)
    if not _MARK.search(text):
        return base, base
    added = []
    for start, end in stretches(text, sorted(base)):
        added += decode(weights, text, start, end)
    return base, in_order(base + added) if added else base


# ---- training examples --------------------------------------------------------------------


def _card_number(rnd: random.Random, good: bool) -> str:
    body = "4" + "".join(rnd.choice("0123456789") for _ in range(14))
    return next(body + c for c in "0123456789" if luhn(body + c) == good)


def written_forms(seed: int = 11, each: int = 30) -> list[tuple[str, list[Span]]]:
    """Forms the patterns miss and look-alikes, each with a few words around it."""
    rnd = random.Random(seed)
    n = lambda k: "".join(rnd.choice("0123456789") for _ in range(k))
    octet = lambda: str(rnd.randrange(256))
    name = lambda: "".join(rnd.choice("abcdefghijklmnoprstu") for _ in range(rnd.randrange(3, 8)))
    gap = lambda: rnd.choice(("  ", "\n", " \n", "\t"))
    prose = lambda: " ".join(name() for _ in range(rnd.randrange(1, 4)))
    makers = [
        ("phone", lambda: f"({n(3)}) {n(3)}-{n(4)}"),
        ("phone", lambda: f"{n(3)}-{n(3)}-{n(4)}"),
        ("phone", lambda: f"{n(3)}.{n(3)}.{n(4)}"),
        ("phone", lambda: f"+{rnd.randrange(1, 99)} ({n(3)}) {n(3)}-{n(4)}"),
        ("phone", lambda: f"({n(3)}) {n(3)} - {n(4)}"),
        ("phone", lambda: f"({n(3)}){gap()}{n(3)}-{n(4)}"),
        ("phone", lambda: f"{n(3)}{gap()}{n(3)}{gap()}{n(4)}"),
        ("card", lambda: re.sub(r"(\d{4})(?=\d)", r"\1 - ", _card_number(rnd, True))),
        ("card", lambda: re.sub(r"(\d{4})(?=\d)", lambda m: m[1] + gap(), _card_number(rnd, True))),
        ("email", lambda: f"{name()} @ {name()}.com"),
        ("email", lambda: f"{name()}{gap()}@{gap()}{name()}.example.org"),
        (None, lambda: re.sub(r"(\d{4})(?=\d)", r"\1 - ", _card_number(rnd, False))),
        (None, lambda: f"{name()} 19{n(2)} {name()} {name()} {n(2)} {name()}"),
        (None, lambda: f"{name()} {n(1)} {name()} {n(3)}, {name()} 20{n(2)}"),
        ("card", lambda: re.sub(r"(\d{4})(?=\d)", r"\1.", _card_number(rnd, True))),
        ("card", lambda: re.sub(r"(\d{4})(?=\d)", r"\1 ", _card_number(rnd, True))),
        ("card", lambda: _card_number(rnd, True)),
        ("ip", lambda: ".".join(octet() for _ in range(4))),
        ("email", lambda: f"{name()}.{n(2)}@{name()}.example.com"),
        ("email", lambda: f"{name()}+{name()}@{name()}.org"),
        (None, lambda: _card_number(rnd, False)),
        (None, lambda: re.sub(r"(\d{4})(?=\d)", r"\1 ", _card_number(rnd, False))),
        (None, lambda: f"20{n(2)}-0{rnd.randrange(1, 9)}-{rnd.randrange(10, 28)}"),
        (None, lambda: f"{rnd.randrange(9)}.{rnd.randrange(99)}.{rnd.randrange(99)}"),
        (None, lambda: f"{rnd.randrange(1, 99)},{n(3)}.{n(2)}"),
        (None, lambda: f"{rnd.randrange(256, 999)}.{octet()}.{rnd.randrange(300, 999)}.{octet()}"),
        (None, lambda: n(rnd.choice((4, 5, 6, 7, 8, 9, 12, 16, 22)))),
        (None, lambda: f"@{name()}"),
        (None, lambda: f"{name()}@{name()}"),
        (None, lambda: f"{name()}{n(rnd.randrange(1, 6))}"),
        (None, lambda: f"{n(4)}-{n(4)}"),
        (None, lambda: "".join(rnd.choice("0123456789abcdef") for _ in range(40))),
    ]
    out = []
    for kind, make in makers:
        for _ in range(each):
            before, after = rnd.choice(("", f"{n(2)} ", "(", '"', "x1 ")), rnd.choice(("", ".", ",", ")", f" {n(3)}", "***"))
            body = make()
            if rnd.random() < 0.5 and not ("@" in body and body[0] != "@" and " " in body):
                before, after = prose() + rnd.choice((" ", ": ", "\n")) + before, after + rnd.choice((" ", "\n", ". ")) + prose()
            text = before + body + after
            out.append((text, [(len(before), len(before) + len(body), kind)] if kind else []))
    return out


def fit(docs: DataFrame, *, text: str = "text", train_docs: int = 4_000, most: int = 600) -> Weights:
    """Weights from the written forms and the stretches of at most ``train_docs`` documents
    (chosen by the hash of the text), ``most`` stretches at the most."""

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for t in batch["t"]:
                if t and _MARK.search(t):
                    found += [s for _, s in zip(range(4), (t[a:b] for a, b in stretches(t, []) if b - a <= 400), strict=False)]
            yield pd.DataFrame({"s": pd.Series(found, dtype=object)})

    sample = drawn(docs.select(F.col(text).cast("string").alias("t")), train_docs, "t").mapInPandas(extract, "s string")
    seen = sorted({row.s for row in sample.collect()})
    seen.sort(key=lambda s: hashlib.blake2b(s.encode()).digest())
    examples = written_forms()
    for s in seen[:most]:
        spans = base_spans(s)
        if spans and all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False)):
            examples.append((s, spans))
    return train(examples)


RESULT = "n_email long, n_ip long, n_card long, n_phone long, base string, spans string"


def detector(docs: DataFrame, weights: Weights):
    """A column function: text to counts, pattern spans and all spans."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf(RESULT)
    def detect(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            base, spans = find(t, shared.value) if t else ([], [])
            rows.append((*(sum(s[2] == k for s in base) for k in KINDS), written(base), written(spans)))
        return pd.DataFrame(rows, columns=[f.split()[0] for f in RESULT.split(", ")], dtype=object)

    return lambda text: detect(F.coalesce(text, F.lit("")))


def redactor(docs: DataFrame, weights: Weights, *, mark: str = "[{}]"):
    """A column function: the text with every span replaced by the name of its kind. Where spans
    of two kinds overlap, one mark covers both and names the first."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("string")
    def redact(texts: pd.Series) -> pd.Series:
        return pd.Series([redacted(t, find(t, shared.value)[1], mark) if t else t for t in texts], dtype=object)

    def apply(text: Column) -> Column:
        return redact(text)

    return apply


def redacted(text: str, spans: list[Span], mark: str = "[{}]") -> str:
    out, at = [], 0
    for start, end, kind in spans:
        if start < at:
            if end > at:
                at = end
            continue
        out += [text[at:start], mark.format(kind.upper())]
        at = end
    return "".join([*out, text[at:]])
