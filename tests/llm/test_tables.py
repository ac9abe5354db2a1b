"""Operators on whole tables against brute force, with odd rows in every one."""

import base64
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from isotherm.llm import decontaminate, minhash, quality_rules, sharding, suffix_dedup, toxicity, warc

WORD = re.compile("[^\x20\x09-\x0d]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(rnd, n, size=400):
    return [f"w{rnd.randrange(size)}" for _ in range(n)]


# ---- near-duplicates ----------------------------------------------------------------------


def _components(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOW))
        sets[i] = {tuple(w)} if 0 < len(w) < k else {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.fixture(scope="module")
def copies():
    rnd = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(110):  # a bucket beyond ALL_PAIRS that spans several components
        w = list(base)
        for _ in range(rnd.randrange(9)):
            w[rnd.randrange(len(w))] = f"z{rnd.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(200 + i, " ".join(_words(rnd, rnd.randrange(1, 60)))) for i in range(40)]
    return [*rows, (300, rows[5][1].upper()), (301, None), (302, ""), (303, " \n"), (304, "A b"), (305, "a  B")]


def test_near_duplicates_equal_brute_force(docs_of, copies):
    got = minhash.near_duplicates(docs_of(copies)).collect()
    want = _components(copies, 4, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_odd_tables(docs_of):
    assert minhash.near_duplicates(docs_of([])).collect() == []
    rows = [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (None, None)]
    got = sorted(map(tuple, minhash.near_duplicates(docs_of(rows)).collect()), key=str)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 0, None, True)], key=str)


def test_pruning_keeps_what_may_match():
    assert minhash.least_matches(32, 0.8, 1e-6) <= minhash.least_matches(32, 0.8, 1e-3) <= 26
    assert minhash.least_matches(128, 0.8, 1e-6) < 128 * 0.8


# ---- benchmark passages -------------------------------------------------------------------


def _shingled(w, k):
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def _leaks(docs, items):
    out = set()
    for d, t in docs:
        w = WORD.findall((t or "").lower())
        for i, x in items:
            x = WORD.findall((x or "").lower())
            best = None
            k = min(5, len(x))
            for s in range(max(len(w) - len(x), 0) + 1) if x else ():  # a shorter text is one window
                a, b = _shingled(w[s : s + len(x)], k), _shingled(x, k)
                both, all_ = sum((a & b).values()), sum((a | b).values())
                if 100 * both >= 80 * all_ and (best is None or both / all_ > best[0]):
                    best = (both / all_, s)
            if best:
                out.add((d, i, *best))
    return out


def test_leaks_equal_brute_force(spark, docs_of):
    rnd = random.Random(5)
    items = [(i, " ".join(_words(rnd, rnd.choice([1, 2, 4, 5, 6, 20, 40, 60])))) for i in range(30)]
    items += [(97, None), (98, ""), (99, "a a a a a a a a b"), (96, items[7][1])]
    docs = []
    for i in range(80):
        x = (rnd.choice(items)[1] or "").split()
        for _ in range(rnd.randrange(3)):
            if x:
                x[rnd.randrange(len(x))] = "zz"
        docs.append((i, " ".join(_words(rnd, rnd.randrange(50)) + x + _words(rnd, rnd.randrange(40)))))
    for i, x in items[:30]:  # shortened items, shorter than any window
        w = x.split()
        docs += [(1000 + i, " ".join(w[: len(w) - len(w) // 20 - 1])), (2000 + i, " ".join(w[len(w) // 12 :]))]
    docs += [(900, None), (901, ""), (902, "a a a a a a a a b"), (903, docs[0][1]), (904, docs[0][1])]
    table = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = decontaminate.leaks(docs_of(docs), table).collect()
    assert {(r.doc_id, r.item_id, r.similarity, r.start_word) for r in got} == _leaks(docs, items)
    assert decontaminate.leaks(docs_of(docs), table.limit(0)).collect() == []
    assert decontaminate.leaks(docs_of([]), table).collect() == []


# ---- repeated passages --------------------------------------------------------------------


def _repeats(rows, length):
    seen = Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for k, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((k, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("variants", [1_024, 3])
def test_repeats_equal_brute_force(docs_of, monkeypatch, variants):
    monkeypatch.setattr(suffix_dedup, "VARIANTS", variants)
    rnd = random.Random(3)
    passage = [" ".join(_words(rnd, 70, 3000)) for _ in range(3)]
    rows = [
        (i, " ".join(_words(rnd, rnd.randrange(60), 3000)) + rnd.choice(passage)[: rnd.randrange(150, 400)] + " ".join(_words(rnd, rnd.randrange(40), 3000)))
        for i in range(60)
    ]
    rows += [(100, None), (101, ""), (102, "a" * 700), (103, "ab" * 300), (104, "x" * 199), (105, "a" * 200), (106, "q" * 200 + "r" * 201)]
    rows += [(107, rows[0][1]), (107, rows[0][1]), (None, passage[0] + "é" * 150 + passage[0])]
    got = suffix_dedup.repeats(docs_of(rows)).collect()
    assert sorted(map(tuple, got), key=str) == _repeats(rows, 200)
    assert suffix_dedup.repeats(docs_of([])).collect() == []


def test_suffixes_are_sorted():
    import numpy as np

    rnd = random.Random(6)
    data = np.frombuffer("".join(rnd.choice("ab") for _ in range(900)).encode(), dtype=np.uint8)
    starts = np.arange(900 - 8)
    order = suffix_dedup.Suffixes(data, 8).sort(starts)
    keys = [bytes(data[s : s + 8]) for s in order]
    assert keys == sorted(keys) and sorted(order.tolist()) == starts.tolist()


# ---- quality rules ------------------------------------------------------------------------


def test_counts_equal_brute_force(docs_of):
    rnd = random.Random(2)
    texts = [" ".join(_words(rnd, rnd.randrange(90), rnd.choice((3, 20, 400)))).replace("w1 ", "#*\n") for _ in range(120)]
    texts += [None, "", " \t\n", "a", "a b", "a b c a b c", "é # é\n\né # é\n\x0b", "<|>&" * 3000]
    rows = list(enumerate(texts))
    for r in quality_rules.with_features(docs_of(rows)).collect():
        t = texts[r.doc_id] or ""
        w = WORD.findall(t)
        seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        again = {i + j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again))
        assert tuple(r.features[c] for c in quality_rules.COUNTS) == want


def test_cutoffs_are_the_last_accepted_ones(spark, docs_of):
    rnd = random.Random(2)
    rows = [(i, " ".join(f"x{rnd.randrange(10**6)}" + "#" * (8 if i % 50 == 0 else 0) for _ in range(60))) for i in range(900)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(900)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    featured = quality_rules.with_features(docs_of(rows))
    found = {r.stratum: r for r in quality_rules.cutoffs(featured, labels, risk=0.2, delta=0.05).collect()}
    share = [r.features["symbols"] for r in featured.collect()]
    level, accepted = 0.05 / 4, None
    for c in quality_rules.CUTOFFS:
        k = sum(s > c for s in share)
        if k > 0.05 * 900 or _tail(k, 900, 0.05) > level:
            break
        accepted = c
    assert found["=en"]["symbols"] == accepted and found["=en"]["n"] == 900
    assert quality_rules.cutoffs(featured, labels.limit(0)).collect() == []


def _tail(k, n, p):
    return math.fsum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))


def test_every_stratum_has_its_own_cutoffs(spark):
    """70 languages of 120 good documents each, one without a label, and documents without a language."""
    rnd = random.Random(8)
    rows = []
    for i in range(72 * 125):
        lang = i // 125
        loud = i % 125 >= 123 if lang % 2 else False  # the last documents of a language have no label
        words = " ".join(f"x{rnd.randrange(10**6)}" + "#" * (9 if loud or (lang == 4 and i % 3 == 0) else 0) for _ in range(55))
        rows.append((i, words, None if lang == 71 else f"l{lang}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(72 * 125) if i % 125 < 120 and i // 125 != 70], "doc_id long, quality int")
    got = quality_rules.verdicts(docs, labels, risk=0.4, delta=0.5).collect()
    level = 0.5 / (4 * 71)
    share = {r.doc_id: [r.features[x] for x in quality_rules.RULES] for r in got}
    cut = {}
    for lang in range(72):
        held = [share[lang * 125 + j] for j in range(120)] if lang != 70 else []
        for rule in range(4):
            for c in quality_rules.CUTOFFS if held else ():
                k = sum(h[rule] > c for h in held)
                if k > 0.1 * 120 or _tail(k, 120, 0.1) > level:
                    break
                cut[lang, rule] = c
    want = {i: not any(share[i][rule] > cut.get((i // 125, rule), 10**9) for rule in range(4)) for i, _, _ in rows}
    assert {r.doc_id: r.features["kept"] for r in got} == want
    assert len({lang for lang, _ in cut}) == 71
    assert {i // 125 for i, kept in want.items() if not kept} >= set(range(1, 70, 2))  # each rejects by its own


def test_binomial_tail(spark):
    cases = [(0, 10, 0.1), (1, 10, 0.1), (3, 900, 0.05), (45, 900, 0.05), (20, 3000, 0.01), (0, 1, 0.5), (90, 1000, 0.1)]
    for k, n, p in cases:
        row = spark.range(1).select(quality_rules.binomial_tail(F.lit(k), F.lit(n), p).alias("t")).head()
        assert row.t == pytest.approx(_tail(k, n, p), rel=1e-9)
    far = spark.range(1).select(quality_rules.binomial_tail(F.lit(9_900_000), F.lit(1_000_000_000), 0.01).alias("t")).head()
    assert 0 < far.t < 1e-200


# ---- shards -------------------------------------------------------------------------------


def test_shards_are_even_and_gapless(docs_of):
    hot = [(i, "hot text " * 30 if i % 3 == 0 else f"{i} " * (i % 40)) for i in range(6000)]
    got = sharding.placed(docs_of([*hot, (1, None), (1, None), (None, "a")])).collect()
    size, slots, where = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in got:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
        where[r.text_crc32].add(r.shard)
    assert sorted(size) == list(range(8)) and len(got) == 6003
    assert max(size.values()) - min(size.values()) <= 0.02 * sum(size.values()) / 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sum(len(s) > 1 for s in where.values()) == 1  # only the group too large for a shard is split
    assert sharding.placed(docs_of([])).collect() == []


# ---- archives -----------------------------------------------------------------------------


def test_archives_give_back_what_was_written(spark):
    rows = [(1, "u\n", None), (2, None, ""), (5, "x", "abc"), (3, "y", "abc"), (None, "z", "abc"), (4, "q", "é" * 200_000), (3, "y", "abc"),
            (None, "w", "only"), (2**60 + 1, "w", "abc")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record_type string")
    got = [tuple(r) for r in warc.read(warc.write(pages)).drop("url").collect()]
    first = defaultdict(list)
    for k, _, h in rows:
        if k is not None:
            first[h or ""].append(k)
    want = []
    for k, _, h in rows:
        body, low = (h or "").encode(), min(first[h or ""], default=None)
        revisit = low is not None and k != low
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        want.append((k, "revisit" if revisit else "response", low if revisit else None, None if revisit else bytearray(body), len(body), digest))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert warc.read(warc.write(pages.limit(0))).collect() == []


def test_damaged_records_fail():
    good = warc.record(7, "http://a", b"body", None, revisit=False)
    assert warc.read_record(good)[0] == 7
    for bad in (good[:-1], good.replace(b"WARC/1.1", b"WARC/9"), good.replace(b"body", b"bodY"), good.replace(b"WARC-Date", b"X")):
        with pytest.raises(ValueError):
            warc.read_record(bad)


# ---- toxicity -----------------------------------------------------------------------------


def test_nearest_are_exact():
    import numpy as np

    rnd = np.random.default_rng(1)
    examples = []
    for _ in range(500):
        t = np.sort(rnd.choice(40, rnd.integers(1, 9), replace=False))
        w = rnd.random(len(t)) + 0.1
        examples.append((t, w / np.linalg.norm(w)))
    index = toxicity.BlockMaxIndex(examples, 40)
    dense = np.zeros((500, 40))
    for i, (t, w) in enumerate(examples):
        dense[i, t] = w
    for t, w in examples[:60]:
        cosine = dense[:, t] @ w
        found, scores = index.nearest(t, w, 10, visit=1)
        assert scores == pytest.approx(np.sort(cosine)[::-1][:10])
        assert cosine[found] == pytest.approx(scores)


def test_scores_of_held_out_texts(spark, docs_of):
    from pyspark.sql import functions as F

    rnd = random.Random(7)
    rows = [(i, " ".join(_words(rnd, 60) + ["vile"] * (i % 4 == 0))) for i in range(400)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    docs = docs_of([*rows, (1000, None), (1001, ""), (1002, "a vile one")])
    model = toxicity.fit(docs, labels, learn=F.col("doc_id") < 300)
    score = toxicity.scorer(docs, model)
    got = {r.doc_id: r.r for r in docs.select("doc_id", score(F.col("text")).alias("r")).collect()}
    assert all((got[i].score >= 0.5) == (i % 4 == 0) for i in range(300, 400))
    assert got[1002].score >= 0.5 > got[1000].score == got[1001].score
    assert got[1002].neighbours and all(i % 4 == 0 for i in got[1002].neighbours)
    none = toxicity.fit(docs, labels.limit(0))
    assert {r.r.score for r in docs.select(toxicity.scorer(docs, none)(F.col("text")).alias("r")).collect()} == {0.0}


def test_every_term_and_example_counts(spark, docs_of):
    """A toxic word beyond any short list, in few toxic examples; neighbours as by brute force."""
    import numpy as np
    from pyspark.sql import functions as F

    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("bcdfgklmnprst") + rnd.choice("aeiou") for _ in range(4))
    common, strong, rare = ([word() for _ in range(n)] for n in (300, 90, 14))
    rows = []
    for i in range(600):
        w = rnd.choices(common, k=12)
        if i % 3 == 0:
            w += [rnd.choice(strong)] * 2 if i % 2 else [rare[(i // 6) % 14]] * 2
        rows.append((i, " ".join(w)))
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(600)], "doc_id long, quality int, toxic int")
    asked = [(1000 + i, f"{w} {w}") for i, w in enumerate(rare)] + [(2000, "clean " + " ".join(common[:8]))]
    docs = docs_of([*rows, *asked])
    model = toxicity.fit(docs, labels, learn=F.col("doc_id") < 600)
    assert model.index.n == 600
    score = toxicity.scorer(docs, model)
    got = {r.doc_id: r.r for r in docs.select("doc_id", score(F.col("text")).alias("r")).collect()}
    found = [i for i, _ in asked[:14]]
    for i, w in asked[:14]:
        own = [j for j, t in rows if w.split()[0] in t.split()]
        assert set(got[i].neighbours[: len(own)]) == set(own) and got[i].score > got[2000].score

    counts = {i: Counter(x for c in t.split() for x in toxicity.terms_of(c)) for i, t in [*rows, *asked]}
    df = Counter(x for c in counts.values() for x in c)
    known = {x for i, _ in rows for x in counts[i]}

    def unit(i):
        w = {x: (1 + math.log(n)) * (math.log((1 + len(counts)) / (1 + df[x])) + 1) for x, n in counts[i].items() if x in known}
        size = math.sqrt(sum(v * v for v in w.values()))
        return {x: v / size for x, v in w.items()}

    units = {i: unit(i) for i, _ in rows}
    for i in (0, 1, 2, found[0], found[-1], 2000):
        q = unit(i)
        cosine = {j: sum(v * u.get(x, 0.0) for x, v in q.items()) for j, u in units.items()}
        best = sorted((c for c in cosine.values() if c > 0), reverse=True)[: toxicity.NEAREST]
        assert got[i].cosines == pytest.approx(best)
        assert [cosine[j] for j in got[i].neighbours] == pytest.approx(best)
    alike = toxicity.BlockMaxIndex([(np.arange(3), np.ones(3))] * 200 + [(np.array([3]), np.ones(1))], 5)
    assert alike.nearest(np.array([3]), np.ones(1), 3)[0].tolist() == [200]
    assert alike.nearest(np.array([0, 3]), np.ones(2), 3)[0].tolist() == [0, 1, 2]


def test_terms_of_many_texts_at_once():
    texts = ["", " ", "Vile-\u03a3\u03b1\u03c2 \u0130stanbul_x9 foo1bar na\u00efve ab ABCDEF abcdefabcdef abcdefabcdef", "a" * 30 + " " + "ab" * 9, "x\x1cyyyyyyy\x85zzzzzz \u00b2\u00b3"]
    want = [Counter(x for c in t.lower().split() for x in toxicity.terms_of(c)) for t in texts]
    found = toxicity.Occurrences.of(texts)
    hashes = {found.term(i): h for i, h in enumerate(found.hash)}
    assert set(hashes) == set().union(*want)
    known = sorted(hashes)[::2]
    begin, terms, tf = toxicity.Vocabulary(np.array([hashes[t] for t in known])).counts(texts)
    for i, w in enumerate(want):
        at = slice(begin[i], begin[i + 1])
        assert dict(zip([known[t] for t in terms[at]], tf[at].tolist(), strict=True)) == {t: w[t] for t in known if t in w}
        assert (np.diff(terms[at]) > 0).all()


def test_few_postings_are_read_one_by_one(monkeypatch):
    """Texts of three vocabularies, with copies: neighbours of many at once as by brute force, few postings read singly."""
    rnd = np.random.default_rng(6)
    share = 1 / np.arange(1, 701) ** 0.7
    rows = [np.sort(rnd.choice(700, 90, replace=False, p=share / share.sum())) + 700 * (i % 3) for i in range(900)]
    rows[400:440] = [rows[400]] * 40
    examples = []
    for t in rows:
        w = rnd.integers(1, 4, len(t)) if len(examples) < 400 or len(examples) > 440 else np.ones(len(t), np.int64)
        examples.append((t, w))
    index = toxicity.BlockMaxIndex(examples, 2100, per_example=np.array([1 / np.linalg.norm(w) for _, w in examples]))
    dense = np.zeros((900, 2100))
    for i, (t, w) in enumerate(examples):
        dense[i, t] = w / np.linalg.norm(w)
    singly = []
    read = toxicity.Blocks._read
    monkeypatch.setattr(toxicity.Blocks, "_read", lambda self, begin, sizes, weights: singly.append(sizes.sum()) or read(self, begin, sizes, weights))
    asked = [(t, w / np.linalg.norm(w)) for t, w in examples]
    skip = [np.array([i]) for i in range(900)]
    for i, (found, cosine) in enumerate(index.nearest_of(asked, 15, skip)):
        every = dense @ dense[i]
        every[i] = -1
        assert cosine == pytest.approx(np.sort(every)[::-1][: len(cosine)]) and every[found] == pytest.approx(cosine) and len(found) == 15
        if 400 <= i < 440:
            assert found.tolist() == [j for j in range(400, 440) if j != i][:15]
    postings = sum(int((dense[:, t] > 0).sum()) for t, _ in asked)
    assert sum(singly) < 0.4 * postings


def test_drawing_shares_are_weighed_back(spark, docs_of):
    """One text in ten is toxic, and nothing in the texts tells which; drawn are as many of either."""
    from pyspark.sql import functions as F

    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("bcdfgklm") + rnd.choice("aeiou") for _ in range(2))
    words = [word() for _ in range(60)]
    docs = docs_of([(i, " ".join(rnd.choices(words, k=8)) if i % 4 else "") for i in range(6000)])
    labels = spark.createDataFrame([(i, 1, int(rnd.random() < 0.1)) for i in range(6000)], "doc_id long, quality int, toxic int")
    learn = F.col("doc_id") < 4000
    rate = labels.filter(learn).agg(F.avg("toxic")).head()[0]
    model = toxicity.fit(docs, labels, learn=learn, toxic=300, clean=300)
    assert model.alone == pytest.approx(rate, abs=0.05)
    score = toxicity.scorer(docs, model)
    got = [r.r.score for r in docs.filter("doc_id >= 4000 AND text <> ''").select(score(F.col("text")).alias("r")).collect()]
    assert sum(got) / len(got) == pytest.approx(rate, abs=0.08)
    assert sum(s >= 0.5 for s in got) < 0.05 * len(got)


def test_many_copies_just_below_the_threshold(spark, docs_of, monkeypatch):
    """300 variants of one text whose pairs lie on both sides of 0.8, and blocks that cut them."""
    rnd = random.Random(17)
    base = [f"b{i}" for i in range(160)]
    rows = []
    for i in range(300):
        w = list(base)
        for _ in range(3 if i % 3 else 4):
            w[rnd.randrange(len(w))] = f"z{rnd.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    want = _components(rows, 4, 80)
    assert 3 < len({c for _, c in want.values()}) < 290
    monkeypatch.setattr(minhash, "BLOCK", 70)
    got = minhash.near_duplicates(docs_of(rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_spanning_links_join_what_brute_force_joins():
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 60, 100, dtype=np.uint64)
    sign = minhash.Signatures(128)
    rows = []
    for i in range(120):
        h = np.unique(np.concatenate([rng.choice(base, 88 + i % 10, replace=False), rng.integers(0, 1 << 60, i % 4, dtype=np.uint64)]))
        rows.append((bytes([i]), bytes([i - i % 5]), len(h), sign(h).tobytes(), h.tobytes()))
    frame = pd.DataFrame(rows, columns=["set", "root", "n", "sig", "hashes"], dtype=object)
    needed = [minhash.least_matches(n, 0.8, 1e-6) for n in range(32, 129, 32)]
    found = minhash.spanning_links(frame[::2], frame, needed, 80)
    sets = {r[0]: set(np.frombuffer(r[4], np.uint64).tolist()) for r in rows}

    def parts(links):
        up = {r[0]: r[1] for r in rows}
        for a, b in links:
            old, new = up[a], up[b]
            up = {k: new if v == old else v for k, v in up.items()}
        return {frozenset(k for k in up if up[k] == v) for v in up.values()}

    alike = [(a, b) for a in sets for b in sets if a != b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and (a[0] % 2 == 0 or b[0] % 2 == 0)]
    assert parts(found) == parts(alike) and len(found) < 120 and set(found) <= {(min(p), max(p)) for p in alike}
