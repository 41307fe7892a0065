"""Jaccard join against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from sparrowscope.llm import jaccard


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def plain(rows, size, percent):
    sets = [(d, shingles(t, size)) for d, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (d, a) in enumerate(sets):
        for j in range(i):
            e, b = sets[j]
            if d is not None and e is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(
        ((d if d is not None else -1), len(s), least[find(i)] if d is not None else -1) for i, (d, s) in enumerate(sets)
    )


def corpus(seed, docs=150, words=60):
    """Texts made of shared passages and chains of small changes."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 400)}"
    passages = [[word() for _ in range(rng.randint(5, words))] for _ in range(6)]
    texts = [[word() for _ in range(rng.randint(0, words))] for _ in range(10)]
    while len(texts) < docs:
        kind = rng.random()
        if kind < 0.6:
            t = list(rng.choice(texts))
            for _ in range(rng.randint(0, 3)):
                if t:
                    t[rng.randrange(len(t))] = word()
        elif kind < 0.9:
            t = [w for _ in range(rng.randint(1, 3)) for w in rng.choice(passages)]
        else:
            t = [word() for _ in range(rng.randint(0, words))]
        texts.append(t)
    rows = [(i, rng.choice([" ", "\n", "\t "]).join(t)) for i, t in enumerate(texts)]
    return rows + [(900, None), (901, ""), (902, "One two"), (903, "one TWO"), (904, "x"), (905, rows[12][1].upper()),
                   (905, rows[12][1]), (906, rows[30][1]), (906, rows[45][1]), (None, rows[30][1]), (None, None)]


@pytest.mark.parametrize("size, percent, frequent, long", [(3, 90, 2, 20), (5, 80, 4, 1000), (1, 80, 2, 40), (2, 70, 3, 10)])
def test_against_all_pairs(spark, docs_of, size, percent, frequent, long):
    rows = corpus(size * 100 + percent)
    found = jaccard.near_duplicates(docs_of(rows, "set"), size, percent, frequent=frequent, long=long)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    got = sorted(tuple(-1 if v is None else v for v in r) for r in found.collect())
    assert got == plain(rows, size, percent)


def test_entries_of_linked_sets_meet():
    rng = random.Random(11)
    for _ in range(3000):
        percent = rng.choice([70, 80, 90])
        universe = list(range(1, 90))
        counts = {t: rng.choice([2, 3, 20, 30]) for t in universe}
        base = rng.sample(universe, rng.randint(2, 40))
        other = [t for t in base if rng.random() < 0.95] + rng.sample(universe, rng.randint(0, 3))
        a, b = set(base), set(other)
        if 100 * len(a & b) < percent * len(a | b):
            continue
        made = []
        for s in (a, b):
            order = sorted(s, key=lambda t: (counts[t], t))
            made.append(set(jaccard.index_entries(
                len(s), np.array(order, np.uint64), np.array([counts[t] for t in order]), percent, 16, 20).tolist()))
        assert a == b or made[0] & made[1], (a, b)


def test_empty_table(docs_of):
    assert jaccard.near_duplicates(docs_of([(1, "a")]).where("doc_id > 5")).collect() == []


def test_difference_entries_of_linked_sets_meet():
    rng = random.Random(12)
    tested = 0
    for _ in range(6000):
        percent = rng.choice([70, 80, 90])
        size = rng.randint(5, 60)
        counts = {t: rng.choice([1, 2, 3, 20, 30]) for t in range(200)}
        pivot = set(rng.sample(range(200), size))

        def edited(base, n):
            base = set(base)
            for _ in range(n):
                base -= set(rng.sample(sorted(base), min(len(base) - 1, rng.randint(0, 3))))
                base |= set(rng.sample(range(200), rng.randint(0, 3)))
            return base

        x = edited(pivot, rng.randint(0, 4))
        z = edited(x, rng.randint(0, 2))
        for t in x & z:
            counts[t] = max(2, counts[t])
        linked = lambda a, b: 100 * len(a & b) >= percent * len(a | b)
        if x == z or pivot in (x, z) or not linked(x, z) or (linked(x, pivot) and linked(z, pivot)):
            continue
        tested += 1
        arrays = {k: (np.array(sorted(s)), np.array([counts[t] for t in sorted(s)])) for k, s in (("x", x), ("z", z), ("p", pivot))}
        made = {k: jaccard.difference_entries(*arrays[k], *arrays["p"], percent) for k in "xz"}
        assert made["x"][0] == linked(x, pivot)
        assert set(made["x"][1].tolist()) & set(made["z"][1].tolist())
    assert tested > 300


def family(seed, copies):
    """Copies of one text, edited as far as 80 % allows, a few of them beyond."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(60)]
    rows = [(0, " ".join(base))]
    for i in range(1, copies):
        t = list(base)
        for k in rng.sample(range(60), rng.choice([1, 2, 3, 4, 5, 5, 6, 6, 6, 7])):
            t[k] = f"v{rng.randint(0, 300)}"
        rows.append((i, " ".join(t)))
    return rows


def test_entries_of_a_family_near_the_threshold_grow_with_it(spark, docs_of, monkeypatch):
    """Entries grow with the family; the comparisons with those of its sets that link with
    none, faster than the family, but stay below all pairs."""
    work, store = {}, jaccard.Tables.store

    def counted(self, df, name):
        table = store(self, df, name)
        if name in ("index", "compared"):
            work[name] = work.get(name, 0) + table.count()
        return table

    monkeypatch.setattr(jaccard.Tables, "store", counted)
    seen = []
    for copies in (100, 300):
        work.clear()
        rows = family(5, copies)
        found = jaccard.near_duplicates(docs_of(rows), 1, 80)
        assert sorted(tuple(r) for r in found.collect()) == plain(rows, 1, 80)
        seen.append(dict(work))
    assert seen[1]["index"] <= 5 * seen[0]["index"], seen
    assert seen[1]["compared"] < 300 * 299 / 2 * 2 / 3, seen


def test_keep_one_with_any_columns(spark, docs_of):
    names = ["__own", "__text", "__id", "__mark", "__row", "component_id", "set", "n"]
    docs = docs_of(corpus(3, 50)[:60])
    wide = docs
    for name in names:
        wide = wide.withColumn(name, jaccard.F.lit(7))
    kept = jaccard.keep_one(wide)
    assert kept.columns == wide.columns
    plain_kept = jaccard.keep_one(docs)
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "")
    assert sorted(map(key, kept.collect())) == sorted(map(key, plain_kept.collect()))
    assert {r["set"] for r in kept.collect()} == {7}
    assert jaccard.keep_one(wide.where("doc_id < -1")).collect() == []


def test_low_percent_is_refused(docs_of):
    with pytest.raises(ValueError):
        jaccard.near_duplicates(docs_of([(1, "a"), (2, "a b")]), 1, 50)


def test_linked_sets_have_equal_segments():
    rng, tested = np.random.default_rng(13), 0
    for _ in range(4000):
        percent = int(rng.choice([51, 70, 80, 90, 97]))
        base = rng.integers(0, 1 << 64, int(rng.integers(2, 400)), np.uint64, False)
        most = jaccard._differing(len(base), len(base), percent)
        gone, new = rng.integers(0, most + 2, 2)
        a = np.unique(base)
        b = np.unique(np.concatenate([base[min(gone, len(base) - 1) :], rng.integers(0, 1 << 64, new, np.uint64, False)]))
        both = len(np.intersect1d(a, b))
        if len(b) < 2 or 100 * both < percent * (len(a) + len(b) - both):
            continue
        tested += 1
        made = [{kind: (need, set(signs.tolist())) for kind, need, signs in jaccard.segment_signs(x, percent)} for x in (a, b)]
        kind = min(max(made[0]), max(made[1]))  # the class of the smaller set
        equal = made[0][kind][1] & made[1][kind][1]
        assert len(equal) >= max(made[0][kind][0], made[1][kind][0]), (percent, len(a), len(b))
    assert tested > 1000


def test_sets_that_share_tokens_by_chance_are_put_aside(spark, docs_of, monkeypatch):
    """All words of all texts occur in many others: only near copies are ordered and indexed."""
    work, store = {}, jaccard.Tables.store

    def counted(self, df, name):
        table = store(self, df, name)
        work.setdefault(name, table.count())
        return table

    monkeypatch.setattr(jaccard.Tables, "store", counted)
    rng = random.Random(14)
    rows = [(i, " ".join(rng.sample([f"w{k}" for k in range(1200)], 120))) for i in range(300)]
    for i in range(10):
        words = rows[i][1].split()
        words[i * 7] = "new"
        rows.append((400 + i, " ".join(words)))
    found = jaccard.near_duplicates(docs_of(rows), 1, 90)
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, 1, 90)
    assert 20 <= work["ordered-sets"] <= 40, work


@pytest.mark.parametrize("slots, words", [(4, 2), (jaccard.SLOTS, jaccard.WORDS)])
def test_may_have_loses_no_row(spark, monkeypatch, slots, words):
    monkeypatch.setattr(jaccard, "SLOTS", slots)
    monkeypatch.setattr(jaccard, "WORDS", words)
    rows = spark.range(5000).selectExpr("id AS slot", "CAST(id % 7 AS string) AS words", "IF(id % 9 = 0, null, id) AS k")
    rows = rows.union(rows.where("k < 100"))
    keys = spark.range(0, 5000, 13).selectExpr("id AS k", "CAST(id % 7 AS string) AS words")
    found = jaccard.may_have(rows, keys, ["k", "words"])
    assert found.columns == rows.columns
    wanted = sorted(tuple(r) for r in rows.where("k % 13 = 0").collect())
    got = sorted((tuple(r) for r in found.where("k % 13 = 0").collect()))
    assert got == wanted
    if slots > 4:
        assert found.count() <= len(wanted) + 50
    assert jaccard.may_have(rows, keys.limit(0), ["k", "words"]).count() == 0


def test_texts_of_lone_sets_are_not_dealt(spark, docs_of, monkeypatch):
    """The texts that meet the chosen sets are those of the chosen rows, not of all."""
    rng = random.Random(8)
    rows = [(k, " ".join(f"v{rng.randint(0, 10**6)}" for _ in range(80))) for k in range(400)]
    rows += [(400 + k, rows[k][1] + f" more{k}") for k in range(10)] + [(500 + k, rows[50][1]) for k in range(30)]
    made, whole = [], jaccard._whole_sets
    monkeypatch.setattr(jaccard, "_whole_sets", lambda r, size: made.append(r) or whole(r, size))
    found = jaccard.near_duplicates(docs_of(rows), size=3, percent=90).collect()
    assert sorted(tuple(r) for r in found) == plain(rows, 3, 90)
    assert "BroadcastHashJoin [slot" in made[0]._jdf.queryExecution().executedPlan().toString()


def test_a_family_with_many_strays_takes_two_rounds(spark, docs_of, monkeypatch):
    """Strays that link with none of a large family do not take its pivots away one by one."""
    made, store = [], jaccard.Tables.store
    monkeypatch.setattr(jaccard.Tables, "store", lambda self, df, name: made.append(name) or store(self, df, name))
    monkeypatch.setattr(jaccard, "MORE", 20)
    monkeypatch.setattr(jaccard, "BLOCK", 1 << 14, raising=False)
    rng = random.Random(15)
    rows = family(6, 150)
    for i in range(60):  # these differ from the original in more than 80 % allow, some from each other by less
        words = rows[0][1].split()
        for k in rng.sample(range(60), 8):
            words[k] = f"u{i // 3}"
        rows.append((500 + i, " ".join(words)))
    found = jaccard.near_duplicates(docs_of(rows), 1, 80)
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, 1, 80)
    assert made.count("compared") <= 2, made
    assert "block-links" in made


@pytest.mark.parametrize("rare, columns, pairs", [(100, 512, 1 << 21), (2, 3, 5), (10**9, 4, 7), (0.001, 5, 3)])
def test_overlaps_of_all_pairs(monkeypatch, rare, columns, pairs):
    for name, value in (("RARE", rare), ("COLUMNS", columns), ("PAIRS", pairs)):
        monkeypatch.setattr(jaccard, name, value)
    rng = np.random.default_rng(16)
    for universe in (30, 60, 600):
        left, right = ([np.unique(rng.integers(0, universe, rng.integers(1, 30))) for _ in range(n)] for n in (25, 14))
        wanted = [[len(set(a.tolist()) & set(b.tolist())) for b in right] for a in left]
        assert jaccard.overlaps(left, right).tolist() == wanted


def test_spanning_pairs_connect_what_links_connect():
    def parts(pairs, n):
        root = list(range(n))
        for _ in range(n):
            for a, b in pairs:
                root[a] = root[b] = min(root[a], root[b])
        return root

    rng = np.random.default_rng(17)
    for share in (0, 0.05, 0.2, 1):
        linked = rng.random((12, 9)) < share
        a, b = jaccard.spanning(linked)
        assert len(a) <= 21
        assert parts(list(zip(a, b)), 21) == parts([(i, 12 + j) for i, j in zip(*np.nonzero(linked))], 21)
