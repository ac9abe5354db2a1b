"""Personal data and secrets: patterns against a plain reading of their rules, models on held-out forms."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from isotherm.llm import pii, secret_scan


def _plain_pii(text):
    out = []
    for kind, pattern in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
                if not 14 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((*m.span(), kind))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def _plain_secrets(text):
    out = []
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    out += [(*m.span(), "assign") for m in assign.finditer(text) if len(m[2]) >= 12]
    out += [(*m.span(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(*m.span(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out, key=lambda s: (s[0], secret_scan.KINDS.index(s[2])))


def test_patterns_equal_their_rules():
    rnd = random.Random(8)
    pool = [*"aZ9.@+-% ()12345:=\"'_", "4111111111111111", "10.0.0.1", "256.1.1.1", "+1 (555) 010-2233", "a.b@c.d", "é", "token=", "secret: ", "AKIA",
            "ABCDEFGHIJ0123456789", "0123456789abcdef0", "API_KEY", "password"]
    for _ in range(3000):
        t = "".join(rnd.choices(pool, k=rnd.randrange(14)))
        assert pii.base_spans(t) == _plain_pii(t)
        assert secret_scan.base_spans(t) == _plain_secrets(t)


def test_crf_finds_held_out_forms_and_leaves_look_alikes():
    weights = pii.train(pii.written_forms(each=15))
    held = pii.written_forms(seed=5, each=6)
    right = sum(sorted(pii.decode(weights, t, 0, len(t))) == sorted(s) for t, s in held)
    assert right >= 0.95 * len(held)


def test_segmentation_is_the_best_of_all():
    weights = pii.train(pii.written_forms(each=4))
    for text, _ in pii.written_forms(seed=2, each=1):
        bounds = pii._bounds(text, 0, len(text))
        scored = {}
        for i, j, f in pii.segments(text, bounds):
            scored.setdefault(i, []).append((j, max(pii._score(weights, f, k) for k in range(4))))
        n = len(bounds) - 1

        after = [0.0] * (n + 1)
        for i in range(n - 1, -1, -1):
            after[i] = max([after[i + 1], *(s + after[j] for j, s in scored.get(i, []) if s > 0)])

        where = {(bounds[i], bounds[j]): max(pii._score(weights, f, k) for k in range(4)) for i, j, f in pii.segments(text, bounds)}
        assert sum(where[a, b] for a, b, _ in pii.decode(weights, text, 0, len(text))) == pytest.approx(after[0])


def test_network_on_held_out_findings():
    net = secret_scan.train(secret_scan.written_findings(each=25), epochs=6)
    held = secret_scan.written_findings(seed=9, each=10)
    scores = net.scores([(*secret_scan.coded(t, s, e), e - s) for t, s, e, _ in held])
    found = scores >= net.threshold
    truth = [y for *_, y in held]
    assert sum(f and y for f, y in zip(found, truth, strict=True)) >= 0.9 * sum(truth)
    assert sum(f and not y for f, y in zip(found, truth, strict=True)) <= 0.1 * (len(truth) - sum(truth))


def test_batches_do_not_change_a_score():
    net = secret_scan.Network.start(3)
    found = [(*secret_scan.coded(t, s, e), e - s) for t, s, e, _ in secret_scan.written_findings(each=3)]
    one = [float(net.logits([f])[0]) for f in found]
    assert net.logits(found, cells=200).tolist() == pytest.approx(one)


def test_columns_over_odd_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (3, "write a.b@c.de"), (3, "write a.b@c.de"), (None, "token = 0123456789abcdef"), (4, "x" * 200_000 + " 10.0.0.1")]
    docs = docs_of(rows)
    detect = pii.detector(docs, pii.fit(docs))
    got = sorted((r.doc_id or 0, r.r.n_email, r.r.n_ip, r.r.base) for r in docs.select("doc_id", detect(F.col("text")).alias("r")).collect())
    assert got == [(0, 0, 0, ""), (1, 0, 0, ""), (2, 0, 0, ""), (3, 1, 0, "email:6:14"), (3, 1, 0, "email:6:14"), (4, 0, 1, "ip:200001:200009")]
    scan = secret_scan.scanner(docs, secret_scan.Network.start(1))
    got = {(r.doc_id, r.r.base) for r in docs.select("doc_id", scan(F.col("text")).alias("r")).collect()}
    assert (None, "assign:0:24,hex:8:24") in got and (1, "") in got
    hidden = docs.select(pii.redactor(docs, pii.train(pii.written_forms(each=3)))(F.col("text")).alias("t")).collect()
    assert {r.t for r in hidden} >= {None, "", "write [EMAIL]"}


def test_threshold_below_one_half_keeps_the_recall():
    """Half of the secrets look like the four times as many other tokens: only a low threshold keeps them."""
    rnd = random.Random(6)
    token = lambda letters: "".join(rnd.choice(letters) for _ in range(20))
    examples = []
    for i in range(600):
        t = token("ABCDEF0123456789") if i % 10 == 0 else token("ghijklmnop0123456789")
        examples.append((t, 0, len(t), int(i % 10 == 0 or i % 10 == 1)))
    net = secret_scan.train(examples, epochs=4)
    mixed = sorted(set(examples))
    random.Random(5).shuffle(mixed)
    held = [e for e in mixed[::3] if e[3]]
    scores = net.scores([(*secret_scan.coded(t, s, e), e - s) for t, s, e, _ in held])
    assert net.threshold < 0.5
    assert (scores >= net.threshold - 1e-12).mean() >= 0.95


def test_keys_without_a_digit_or_a_letter_are_found():
    """Recall over whole texts, before any candidate is made."""
    net = secret_scan.train(secret_scan.written_findings(each=40), epochs=6)
    rnd = random.Random(21)
    some = lambda letters, n: "".join(rnd.choice(letters) for _ in range(n))
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    for make in (lambda: some(letters, 24), lambda: some("0123456789", 28)):
        hits = 0
        for _ in range(40):
            body = make()
            t = "the key is " + body + " for now"
            tokens = list(secret_scan.candidates(t))
            hits += (11, 11 + len(body)) in tokens and net.scores([(*secret_scan.coded(t, 11, 11 + len(body)), len(body))])[0] >= net.threshold
        assert hits >= 32
    plain = "misunderstanding of internationalisation, well-established - straightforward responsibilities"
    tokens = list(secret_scan.candidates(plain))
    assert [plain[a:b] for a, b in tokens] == ["misunderstanding", "internationalisation", "well-established", "straightforward", "responsibilities"]


def test_spaced_and_broken_forms_in_running_text():
    weights = pii.train(pii.written_forms())
    forms = [("(555) 123 - 4567", "phone"), ("(555)  123-4567", "phone"), ("(555)\n123-4567", "phone"), ("4111 - 1111 - 1111 - 1111", "card"),
             ("4111  1111  1111  1111", "card"), ("4111\n1111\n1111\n1111", "card"), ("john @ example.com", "email")]
    for form, kind in forms:
        for before, after in (("", ""), (": ", "."), ("(", ")")):
            text = before + form + after
            assert (len(before), len(before) + len(form), kind) in pii.find(text, weights)[1], text


def test_stretches_hold_every_segment():
    """Every segment of the whole text lies in one stretch, whatever lies between its digits."""
    rnd = random.Random(31)
    for _ in range(60):
        text = "".join(rnd.choice(("word", "a", " ", "  ", "\n", "1", "2024", "@", ".", "-", "(", "one two three four five six seven eight ")) for _ in range(40))
        bounds = pii._bounds(text, 0, len(text))
        held = list(pii.stretches(text, []))
        assert all(a[1] <= b[0] for a, b in zip(held, held[1:], strict=False))
        for i, j, _ in pii.segments(text, bounds):
            assert any(a <= bounds[i] and bounds[j] <= b for a, b in held)


def test_calibration_of_separable_classes_is_finite():
    x, y = np.r_[np.full(300, -40.0), np.full(100, 55.0)], np.r_[np.zeros(300), np.ones(100)]
    slope, shift = secret_scan.platt(x, y)
    assert 0 < slope < 2 and abs(shift) < 50
    rng = np.random.default_rng(1)
    x = rng.normal(0, 2, 20_000)
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(1.7 * x - 0.6)))).astype(float)
    assert secret_scan.platt(x, y, ridge=0.0) == pytest.approx((1.7, -0.6), abs=0.1)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_network_of_a_table(spark, sf):
    """Trained as the query trains it: finite, recall and precision on unseen findings, plain words left alone."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text")
    net = secret_scan.fit(docs)
    assert 0 < net.slope < 5 and np.isfinite(net.shift) and 0.0 < net.threshold < 1.0
    held = secret_scan.written_findings(seed=9, each=20)
    hit = net.logits([(*secret_scan.coded(t, s, e), e - s) for t, s, e, _ in held]) >= net.cut
    truth = np.array([y for *_, y in held], bool)
    assert hit[truth].mean() >= 0.9 and truth[hit].mean() >= 0.9
    rows = docs.select(secret_scan.scanner(docs, net)(F.col("text")).alias("r")).select("r.*").collect()
    added = sum(s.startswith("model") for r in rows for s in r.spans.split(","))
    assert added <= 0.01 * sum(r.n_candidates for r in rows)


def test_long_tokens_and_many_patterns():
    net = secret_scan.Network.start(3)
    text = "".join(random.Random(4).choice("abcXYZ019+/") for _ in range(300_000))
    codes, place = secret_scan.padded([(*secret_scan.coded(text, 0, len(text)), len(text))])
    assert net.pooled(codes, place, cells=7_001).tolist() == net.forward(codes, place)["pooled"].tolist()
    tokens = [(i * 40, i * 40 + 30) for i in range(50_000)]
    base = [(i * 40 + 29, i * 40 + 39, "hex") for i in range(0, 50_000, 2)]
    kept = list(secret_scan.apart(tokens, base))
    assert kept == [t for i, t in enumerate(tokens) if i % 2]
    rnd = random.Random(8)
    for _ in range(200):
        cuts = sorted(rnd.sample(range(200), 12))
        tokens = list(zip(cuts[::2], cuts[1::2], strict=True))
        base = [(a, a + rnd.randrange(1, 30), "hex") for a in rnd.sample(range(200), 5)]
        assert list(secret_scan.apart(tokens, base)) == [t for t in tokens if not any(b[0] < t[1] and b[1] > t[0] for b in base)]
