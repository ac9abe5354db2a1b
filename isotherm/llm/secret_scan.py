"""Secrets: fixed patterns plus spans that a character convolutional network adds.

The patterns of ``base_spans`` always stand. A candidate is every token of at least
``SHORTEST`` characters out of letters, digits and ``+/_.=-``, with or without digits.
The network reads the whole candidate and ``BESIDE`` characters on either side: a convolution
over characters and their types, the maxima inside and beside the candidate, one hidden layer,
one logit. It is trained here in numpy on labelled findings: what the patterns find, and what
they leave, in at most ``train_docs`` documents, together with written-out key formats and
look-alikes. A held-out third calibrates the logit (Platt, by damped Newton steps with a ridge) and
sets the logit from which a candidate is reported: the highest one whose recall is at least ``recall`` by an
exact binomial lower bound, or if there is none the highest with that recall as observed
(``Network.exact`` says which). Tokens of any length are read whole, ``CELLS`` characters at a time.

Defined cases: null and empty texts have no spans. Spans count code points, end exclusive, in
the order of start, then kind as listed in ``KINDS``. An added span overlaps no pattern span.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.llm.common import drawn

KINDS = ("assign", "access", "hex", "model")
SHORTEST, BESIDE, TAPS, FILTERS, HIDDEN = 12, 24, 5, 24, 16
#: Places (characters x candidates) the network holds at once.
CELLS = 40_000
Span = tuple[int, int, str]

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
_KEYWORDS = ("password", "passwd", "secret", "token", "api")
# read from the left, so a match begins where its token does
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % SHORTEST)


def base_spans(text: str) -> list[Span]:
    """The pattern spans, leftmost and non-overlapping within a kind. A pattern's shorter
    matches are consumed and dropped."""
    found: list[Span] = []
    if "=" in text or ":" in text:
        low = text.lower()
        if any(k in low for k in _KEYWORDS):
            found += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def candidates(text: str) -> Iterator[tuple[int, int]]:
    for m in _CANDIDATE.finditer(text):
        yield m.span()


# ---- the network --------------------------------------------------------------------------

_OTHER, _SIZE = 128, 130  # code of any other character; 129 pads
_TYPE = np.full(_SIZE, 5, dtype=np.int64)
for _c in range(128):
    _s = chr(_c)
    _TYPE[_c] = 0 if _s.islower() else 1 if _s.isupper() else 2 if _s.isdigit() else 3 if _s.isspace() else 4
_TYPE[129] = 6


def coded(text: str, start: int, end: int) -> tuple[np.ndarray, int]:
    """Codes of a candidate with its surroundings, and where the candidate begins in them."""
    left = max(0, start - BESIDE)
    raw = np.frombuffer(text[left : end + BESIDE].encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where(raw < 128, raw, _OTHER).astype(np.int64), start - left


def padded(found: list[tuple[np.ndarray, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """One array of codes for several candidates, and which places lie inside a candidate
    (1), beside it (0) or in the padding (-1)."""
    width = max(len(c) for c, _, _ in found)
    codes = np.full((len(found), width + TAPS - 1), 129, dtype=np.int64)
    place = np.full((len(found), width), -1, dtype=np.int8)
    for r, (c, at, length) in enumerate(found):
        codes[r, TAPS // 2 : TAPS // 2 + len(c)] = c
        place[r, : len(c)] = 0
        place[r, at : at + length] = 1
    return codes, place


@dataclass
class Network:
    chars: np.ndarray  # character, tap, filter
    types: np.ndarray  # type, tap, filter
    bias: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    #: Logit from which a candidate is reported, and the recall it was chosen for: ``exact`` if the
    #: binomial bound holds on the held-out findings, else the share observed there.
    cut: float = 0.0
    exact: bool = False

    PARTS = ("chars", "types", "bias", "w1", "b1", "w2", "b2")

    @classmethod
    def start(cls, seed: int) -> Network:
        g = np.random.default_rng(seed)
        return cls(
            g.normal(0, 0.05, (_SIZE, TAPS, FILTERS)), g.normal(0, 0.3, (7, TAPS, FILTERS)), np.zeros(FILTERS),
            g.normal(0, 0.2, (2 * FILTERS + 1, HIDDEN)), np.zeros(HIDDEN), g.normal(0, 0.3, HIDDEN), np.zeros(1),
        )

    def forward(self, codes: np.ndarray, place: np.ndarray) -> dict:
        width = place.shape[1]
        kinds = _TYPE[codes]
        conv = np.broadcast_to(self.bias, (*place.shape, FILTERS)).copy()
        for t in range(TAPS):
            conv += self.chars[codes[:, t : t + width], t] + self.types[kinds[:, t : t + width], t]
        np.maximum(conv, 0, out=conv)
        inside = np.where((place == 1)[:, :, None], conv, -1)
        beside = np.where((place == 0)[:, :, None], conv, -1)
        a, b = inside.argmax(1), beside.argmax(1)
        size = np.log((place == 1).sum(1, keepdims=True)) / 4
        pooled = np.concatenate([np.maximum(inside.max(1), 0), np.maximum(beside.max(1), 0), size], 1)
        hidden = np.maximum(pooled @ self.w1 + self.b1, 0)
        return {"a": a, "b": b, "pooled": pooled, "hidden": hidden, "logit": hidden @ self.w2 + self.b2[0]}

    def slopes(self, codes: np.ndarray, place: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        out = self.forward(codes, place)
        d = (1 / (1 + np.exp(-out["logit"])) - labels) / len(labels)
        w2, b2 = out["hidden"].T @ d, np.array([d.sum()])
        dh = np.outer(d, self.w2) * (out["hidden"] > 0)
        w1, b1 = out["pooled"].T @ dh, dh.sum(0)
        dp = dh @ self.w1.T * (out["pooled"] > 0)
        bias, each = np.zeros_like(self.bias), np.arange(FILTERS)[None, :]
        rows, taps, parts = np.arange(len(codes))[:, None, None], np.arange(TAPS)[None, :, None], []
        for at, part in ((out["a"], dp[:, :FILTERS]), (out["b"], dp[:, FILTERS : 2 * FILTERS])):
            bias += part.sum(0)
            parts.append((codes[rows, at[:, None, :] + taps], np.broadcast_to(part[:, None, :], (len(codes), TAPS, FILTERS))))
        code, value = (np.concatenate(x) for x in zip(*parts, strict=True))
        cell = taps * FILTERS + each[None]

        def gathered(index: np.ndarray, like: np.ndarray) -> np.ndarray:
            flat = (index * (TAPS * FILTERS) + cell).ravel()
            return np.bincount(flat, value.ravel(), minlength=like.size).reshape(like.shape)

        chars, types = gathered(code, self.chars), gathered(_TYPE[code], self.types)
        return [chars, types, bias, w1, b1, w2, b2]

    def pooled(self, codes: np.ndarray, place: np.ndarray, *, cells: int = CELLS) -> np.ndarray:
        """What :meth:`forward` pools, held for ``cells`` places at a time: maxima of pieces combine exactly."""
        width, piece = place.shape[1], max(1, cells // len(place))
        inside, beside = np.zeros((len(place), FILTERS)), np.zeros((len(place), FILTERS))
        for s in range(0, width, piece):
            e = min(s + piece, width)
            conv = np.broadcast_to(self.bias, (len(place), e - s, FILTERS)).copy()
            for t in range(TAPS):
                part = codes[:, s + t : e + t]
                conv += self.chars[part, t] + self.types[_TYPE[part], t]
            for pool, kind in ((inside, 1), (beside, 0)):
                np.maximum(pool, np.where((place[:, s:e] == kind)[:, :, None], conv, -1).max(1), out=pool)
        size = np.log((place == 1).sum(1, keepdims=True)) / 4
        return np.concatenate([inside, beside, size], 1)

    def logits(self, found: list[tuple[np.ndarray, int, int]], *, cells: int = CELLS) -> np.ndarray:
        """Logits of candidates, in batches of similar length and bounded size. A longer
        candidate than that is read by itself, piece by piece."""
        out = np.empty(len(found))
        order = sorted(range(len(found)), key=lambda i: len(found[i][0]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end + 1 - at) * len(found[order[end]][0]) <= cells:
                end += 1
            some = order[at:end]
            pooled = self.pooled(*padded([found[i] for i in some]), cells=cells)
            out[some] = np.maximum(pooled @ self.w1 + self.b1, 0) @ self.w2 + self.b2[0]
            at = end
        return out

    def calibrated(self, logits: np.ndarray) -> np.ndarray:
        return np.exp(-np.logaddexp(0, -(self.slope * logits + self.shift)))

    def scores(self, found: list[tuple[np.ndarray, int, int]]) -> np.ndarray:
        return self.calibrated(self.logits(found))


    @property
    def threshold(self) -> float:
        """The cut as a calibrated score."""
        return float(self.calibrated(np.array(self.cut)))


def platt(x: np.ndarray, y: np.ndarray, *, ridge: float = 0.01, steps: int = 100) -> tuple[float, float]:
    """Slope and shift of the calibrated score of logits x with labels y.

    Newton steps on the log loss with smoothed targets, halved until the loss falls; the
    ridge holds the slope near 1 where the classes are apart, so it is always finite.
    """
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))

    def loss(a: float, b: float) -> float:
        z = a * x + b
        return float((np.logaddexp(0, z) - target * z).sum() + ridge * len(x) * (a - 1) ** 2 / 2)

    a, b = 1.0, 0.0
    now = loss(a, b)
    for _ in range(steps):
        p = np.exp(-np.logaddexp(0, -(a * x + b)))
        w = p * (1 - p)
        g = np.array([((p - target) * x).sum() + ridge * len(x) * (a - 1), (p - target).sum()])
        h = np.array([[(w * x * x).sum() + ridge * len(x), (w * x).sum()], [(w * x).sum(), w.sum() + 1e-9]])
        move, size = np.linalg.solve(h, g), 1.0
        while size > 1e-9 and (new := loss(a - size * move[0], b - size * move[1])) > now:
            size /= 2
        if size <= 1e-9 or now - new <= 1e-12 * abs(now):
            break
        a, b, now = a - size * move[0], b - size * move[1], new
    return float(a), float(b)


def binomial_lower(hits: int, n: int, risk: float) -> float:
    """Clopper-Pearson lower bound by bisection on the binomial tail."""
    from math import exp, lgamma, log

    if hits == 0:
        return 0.0
    choose = [lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) for k in range(hits, n + 1)]
    low, high = 0.0, hits / n
    for _ in range(50):
        p = (low + high) / 2
        tail = sum(exp(c + k * log(p) + (n - k) * log(1 - p)) for k, c in enumerate(choose, hits)) if p > 0 else 0.0
        low, high = (p, high) if tail < risk else (low, p)
    return low


def train(examples: list[tuple[str, int, int, int]], *, seed: int = 5, epochs: int = 8, recall: float = 0.95, risk: float = 0.05) -> Network:
    """Fit on two thirds of the examples (text, start, end, label); calibrate on the rest."""
    examples = sorted(set(examples))
    random.Random(seed).shuffle(examples)
    held = examples[::3]
    fitted = [e for i, e in enumerate(examples) if i % 3]
    net = Network.start(seed)
    ready = [(*coded(t, s, e), e - s) for t, s, e, _ in fitted]
    labels = np.array([y for *_, y in fitted], dtype=float)
    moments = [(np.zeros_like(getattr(net, p)), np.zeros_like(getattr(net, p))) for p in net.PARTS]
    order, step = np.random.default_rng(seed), 0
    for _ in range(epochs):
        mixed = order.permutation(len(ready))
        for at in range(0, len(mixed), 32):
            some = mixed[at : at + 32]
            step += 1
            for p, g, (m, v) in zip(net.PARTS, net.slopes(*padded([ready[i] for i in some]), labels[some]), moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                getattr(net, p)[...] -= 0.004 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    x = net.logits([(*coded(t, s, e), e - s) for t, s, e, _ in held])
    y = np.array([y for *_, y in held], dtype=float)
    net.slope, net.shift = platt(x, y) if len(x) else (1.0, 0.0)
    logits = np.sort(x[y == 1])
    if not len(logits):
        net.cut = np.inf  # nothing to find was ever seen
        return net
    kept = next((k for k in range(len(logits)) if binomial_lower(k, len(logits), risk) >= recall), None)
    net.exact = kept is not None
    kept = kept if kept is not None else int(np.ceil(recall * len(logits)))
    net.cut = float(logits[len(logits) - kept])
    return net


# ---- labelled findings --------------------------------------------------------------------


def written_findings(seed: int = 3, each: int = 70) -> list[tuple[str, int, int, int]]:
    """Known key formats with label 1 and look-alikes with label 0, in a few contexts."""
    rnd = random.Random(seed)
    some = lambda letters, n: "".join(rnd.choice(letters) for _ in range(n))
    alnum, b64 = string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/"
    word = lambda: some("aeiourstnlmdhc", rnd.randrange(3, 9))
    makers = [
        (1, lambda: "ghp_" + some(alnum, 36)), (1, lambda: "xoxb-" + some(string.digits, 11) + "-" + some(alnum, 24)),
        (1, lambda: "sk_live_" + some(alnum, 24)), (1, lambda: "AIza" + some(alnum + "_-", 35)),
        (1, lambda: "eyJ" + some(alnum, 17) + "." + some(alnum, 40) + "." + some(alnum + "_-", 43)),
        (1, lambda: some(b64, rnd.choice((24, 32, 40, 64))) + rnd.choice(("", "=", "=="))),
        (1, lambda: some(alnum, rnd.randrange(20, 48))), (1, lambda: some("0123456789ABCDEF", 32)),
        (1, lambda: some(string.ascii_letters, rnd.randrange(14, 41))), (1, lambda: some(string.digits, rnd.randrange(20, 41))),
        (1, lambda: "AKIA" + some(string.ascii_uppercase + string.digits, 16)), (1, lambda: some("0123456789abcdef", 40)),
        (0, lambda: f"{word()}{rnd.randrange(1, 99)}.{word()}.{word()}"), (0, lambda: f"{word()}-{word()}-{rnd.randrange(1, 2030)}"),
        (0, lambda: f"{word()}_{word()}_{rnd.randrange(1, 99)}.{rnd.choice(('txt', 'py', 'html', 'csv'))}"),
        (0, lambda: f"/{word()}/{word()}/{rnd.randrange(1, 9999)}/{word()}"), (0, lambda: f"{word()}{word()}{rnd.randrange(1, 9)}"),
        (0, lambda: f"20{some(string.digits, 2)}-0{rnd.randrange(1, 9)}-1{rnd.randrange(9)}T0{rnd.randrange(9)}"),
        (0, lambda: str(uuid.UUID(int=rnd.getrandbits(128)))[:8] + "-" + word() + "-" + word()),
        (0, lambda: f"{word()}.{word()}{rnd.randrange(9)}.example.{rnd.choice(('com', 'org', 'net'))}"),
        (0, lambda: f"v{rnd.randrange(9)}.{rnd.randrange(99)}.{rnd.randrange(99)}-{word()}{rnd.randrange(9)}"),
        (0, lambda: f"{word()}{word()}{word()}{rnd.randrange(9)}{word()}"),
        (0, lambda: f"{word()}{word()}{word()}{rnd.choice(('', '.', '...'))}"), (0, lambda: (word() + word() + word()).capitalize()),
        (0, lambda: (word() + word() + word()).upper() + rnd.choice(("", "!!", ".", ","))), (0, lambda: f"{word()}-{word()}-{word()}".upper()),
        (0, lambda: f"{word()}-{word()}-{word()}"), (0, lambda: f"{word()}_{word()}.{word()}"), (0, lambda: rnd.choice("-=_.") * rnd.randrange(12, 60)),
        (0, lambda: f"20{some(string.digits, 2)}-0{rnd.randrange(1, 9)}-1{rnd.randrange(9)}.{some(string.digits, 2)}.{some(string.digits, 2)}"),
        (0, lambda: f"{rnd.randrange(1, 9)}.{some(string.digits, 12)}"), (0, lambda: f"20{some(string.digits, 2)}0{rnd.randrange(1, 9)}1{some(string.digits, 7)}"),
    ]
    out = []
    for label, make in makers:
        for _ in range(each):
            body = make()
            if len(body) < SHORTEST:
                continue
            before = " ".join(word() for _ in range(rnd.randrange(4))) + rnd.choice((" ", "\n", " (", ' "', " key: ", "@" if not label else " "))
            after = rnd.choice((" ", ". ", '"', ")", "\n", "")) + " ".join(word() for _ in range(rnd.randrange(4)))
            out.append((before + body + after, len(before), len(before) + len(body), label))
    return out


def fit(docs: DataFrame, *, text: str = "text", train_docs: int = 4_000, most: int = 1_200) -> Network:
    """The network, trained on written findings and on those of at most ``train_docs``
    documents (chosen by the hash of the text), ``most`` findings at the most."""

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for t in batch["t"]:
                tokens = [c for c in candidates(t) if c[1] - c[0] <= 300][:6] if t else []
                for start, end in tokens:
                    left = max(0, start - BESIDE)
                    s = t[left : end + BESIDE]
                    hit = any(b[0] < end - left and b[1] > start - left for b in base_spans(s))
                    out.append((s, start - left, end - left, int(hit)))
            yield pd.DataFrame(out, columns=["s", "a", "b", "y"], dtype=object)

    sample = drawn(docs.select(F.col(text).cast("string").alias("t")), train_docs, "t")
    found = {tuple(r) for r in sample.mapInPandas(extract, "s string, a int, b int, y int").collect()}
    found = sorted(found, key=lambda f: hashlib.blake2b(repr(f).encode("utf-8", "surrogatepass")).digest())
    return train(written_findings() + found[:most])


def find(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """Pattern spans and all candidates of a text."""
    return base_spans(text), list(candidates(text))


def apart(tokens: list[tuple[int, int]], base: list[Span]) -> Iterator[tuple[int, int]]:
    """Candidates that no pattern span overlaps; both lists are walked once. Tokens are in order and apart."""
    spans, at = sorted(base), 0
    reach = 0  # end of the furthest span that begins before the token's end
    for start, end in tokens:
        while at < len(spans) and spans[at][0] < end:
            reach = max(reach, spans[at][1])
            at += 1
        if reach <= start:
            yield start, end


RESULT = "n_assign long, n_access long, n_hex long, n_candidates long, base string, spans string"


def scanner(docs: DataFrame, network: Network):
    """A column function: text to counts, pattern spans and all spans."""
    shared = docs.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf(RESULT)
    def scan(texts: pd.Series) -> pd.DataFrame:
        net, found, pairs = shared.value, [], []
        for i, t in enumerate(texts):
            base, tokens = find(t) if t else ([], [])
            found.append((base, len(tokens)))
            pairs += [(i, s, e, *coded(t, s, e)) for s, e in apart(tokens, base)]
        added: dict[int, list[Span]] = {}
        if pairs:
            logits = net.logits([(c, at, e - s) for _, s, e, c, at in pairs])
            for (i, s, e, _, _), logit in zip(pairs, logits, strict=True):
                if logit >= net.cut:
                    added.setdefault(i, []).append((s, e, "model"))
        rows = []
        for i, (base, n) in enumerate(found):
            spans = in_order(base + added[i]) if i in added else base
            rows.append((*(sum(b[2] == k for b in base) for k in KINDS[:3]), n, written(base), written(spans)))
        return pd.DataFrame(rows, columns=[f.split()[0] for f in RESULT.split(", ")], dtype=object)

    return lambda text: scan(F.coalesce(text, F.lit("")))
