"""Periodic runs, circulant MinHash and whitening against plain versions."""

import collections
import hashlib
import math
import random
import re
import zlib
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from candlewick.llm import minhash, periodic, whitening

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w):
    n, found = len(w), []
    for q in range(1, n):
        i = 0
        while i + q < n:
            if w[i] == w[i + q]:
                j = i
                while j + q < n and w[j] == w[j + q]:
                    j += 1
                s, e = i, j + q
                smaller = any(all(w[k] == w[k + p] for k in range(s, e - p)) for p in range(1, q))
                if e - s >= max(6, 4 * q) and not smaller:
                    found.append((s, e, q))
                i = j
            i += 1
    return sorted(found)


def repetitive(rng):
    letters, size, w = rng.choice([1, 2, 3, 10, 1000]), rng.choice([5, 20, 60, 200, 400]), []
    while len(w) < size:
        b = [rng.randrange(letters) for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 12, 15, 16, 17, 24, 31, 33, 40, 64]))]
        if rng.random() < 0.5:
            b = b * rng.randrange(1, 6) + [rng.randrange(letters)]
        w += b * rng.randrange(1, 8) + b[: rng.randrange(len(b) + 1)]
    return w[:size]


def test_runs_of_repetitive_words():
    rng = random.Random(5)
    some = [repetitive(rng) for _ in range(300)]
    for w in some:
        assert periodic.runs(np.array(w)) == plain_runs(w)
    assert {q >= 8 for w in some for _, _, q in plain_runs(w)} == {True, False}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=120))
def test_runs_of_any_two_letters(w):
    assert periodic.runs(np.array(w, np.int64)) == plain_runs(w)


def test_synchronising_sets_are_consistent_and_dense():
    rng = random.Random(6)
    for scale in (8, 16):
        w = np.array([rng.randrange(3) for _ in range(300)] * 2 + [1] * 100 + [rng.randrange(2) for _ in range(200)])
        h = periodic._mix(w.astype(np.uint64) + np.uint64(1))
        for width in (1, 2, 4, 8)[: int(math.log2(scale))]:
            h = periodic._twice(h, width)
        high = periodic._highly_periodic(len(h), plain_runs(w.tolist()), scale)
        chosen = set(periodic.synchronising_set(h, high, scale).tolist())
        context = {}
        for i in range(len(w) - 2 * scale + 1):
            context.setdefault(tuple(w[i : i + 2 * scale].tolist()), set()).add(i in chosen)
        assert all(len(v) == 1 for v in context.values())
        for i in range(len(w) - 3 * scale + 2):
            assert any(j in chosen for j in range(i, i + scale)) != bool(high[i : i + 2 * scale].all())


def test_periodic_query(spark):
    rng, rows = random.Random(7), []
    for i in range(200):
        rows.append((i, " ".join(f"w{x}" for x in repetitive(rng)).replace(" ", " \n\t", 1)))
    rows += [(None, "a " * 30), (500, None), (501, ""), (502, " \t\n"), (503, "a"), (7, rows[7][1]), (504, "é b " * 40000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as runs", "2 as start", "'x' as `a.b`")
    found = periodic.digests(periodic.detect(docs, periodic.planted))
    assert found.columns == "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()

    def wanted(doc_id, text):
        w = WORD.findall(text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(w)
        if doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(w) if n < 1000 else [(0, n, 2)]
        best = min(runs, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]), default=None)
        gone = {i for s, e, q in runs for i in range(s + q, e)}
        lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        first = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return (doc_id, len(runs), *first, sha(lines), sha(kept))

    assert sorted(map(tuple, found.collect()), key=str) == sorted((wanted(*r) for r in rows), key=str)
    assert periodic.detect(docs.limit(0)).count() == 0
    shown = {r.doc_id: r for r in periodic.detect(docs.where("doc_id in (503, 504)")).collect()}
    assert shown[504].collapsed == "é b" and [tuple(x) for x in shown[504].runs] == [(0, 80000, 2)]


def plain_components(rows, shingle=3, percent=85):
    sets = []
    for _, text in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))} if w else set())
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = find(i), find(j)
                label[max(x, y)] = min(x, y)
    least = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    result = []
    for i, (d, _) in enumerate(rows):
        c = min((x for x in least[find(i)] if x is not None), default=None)
        result.append((d, len(sets[i]), c, d == c))
    return sorted(result, key=str)


def test_minhash_components(spark, cell=4):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    rows = [(9, "one two"), (8, "One TWO"), (7, None), (6, ""), (5, " \n"), (None, "x y z"), (None, "X y z"), (None, ""), (4, "z"), (4, "z")]
    for g in range(3):
        base = rng.choices(words, k=120)
        for i in range(25):
            rows.append((1000 * g + 100 + i, " ".join(w if rng.random() > 0.02 * g else rng.choice(words) for w in base)))
        rows.append((None, " ".join(base)))
    same, other = (" ".join(rng.choices(words, k=60)) for _ in range(2))
    rows += [(3, same), (3, other), (2, other), (1, same + " more"), (3, same)]  # one doc_id, two texts
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as node", "2 as id", "3 as cell", "'x' as `a.b`")
    found = minhash.near_duplicates(docs, cell=cell)
    want = plain_components(rows)
    assert sorted(map(tuple, found.collect()), key=str) == want
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    sizes = collections.Counter(r[2] for r in want)
    assert any(n > 20 for n in sizes.values()) and sum(n == 1 for n in sizes.values()) > 10  # links, and near misses
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_large_neighbourhoods_by_their_buckets(spark):
    shared = [(n, 10 * (n // 2), 2) for n in range(20)] + [(n, 10 * ((n + 1) // 2) + 5, 2) for n in range(1, 19)]
    shared = spark.createDataFrame(shared, "node long, key long, size long")
    roots = spark.createDataFrame([(n, 0) for n in range(20)], "node long, root long")
    met = collections.defaultdict(set)
    for r in minhash.cells(shared, roots, cell=4).collect():
        assert r.cell.startswith("b")  # a chain: fewer comparisons bucket by bucket
        met[r.cell].add(r.node)
    pairs = {(a, b) for own in met.values() for a in own for b in own if a < b}
    assert pairs >= {(n, n + 1) for n in range(19)} and len(pairs) < 40
    one = spark.createDataFrame([(n, 1, 20) for n in range(20)], "node long, key long, size long")
    met = collections.defaultdict(set)
    for r in minhash.cells(one, roots, cell=4).collect():
        assert r.cell.startswith("n")
        met[r.cell].add(r.node)
    assert {(a, b) for own in met.values() for a in own for b in own if a < b} == {(a, b) for b in range(20) for a in range(b)}


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(9)
    a = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    b = np.concatenate([a[:3000], rng.integers(0, 1 << 63, 1000).astype(np.uint64)])
    same = (minhash.signature(a, 1000) == minhash.signature(b, 1000)).mean()
    assert same == pytest.approx(3000 / 5000, abs=0.06)


def exact(x):
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    return n, s, [[n * sum(r[i] * r[j] for r in x) - s[i] * s[j] for j in range(d)] for i in range(d)]


def test_characteristic_polynomial():
    rng = random.Random(10)
    for d in (1, 2, 3, 5, 8):
        x = [[rng.randrange(-300, 300) for _ in range(d)] for _ in range(rng.randrange(2, 20))]
        _, _, m = exact(x)
        # Faddeev-LeVerrier in fractions
        c, b = [Fraction(1)], [[Fraction(0)] * d for _ in range(d)]
        for k in range(1, d + 1):
            b = [[sum(m[i][t] * b[t][j] for t in range(d)) + (c[-1] if i == j else 0) for j in range(d)] for i in range(d)]
            c.append(-sum(sum(m[i][t] * b[t][i] for t in range(d)) for i in range(d)) / Fraction(k))
        assert whitening.characteristic_polynomial(m) == c


def test_roots_and_components():
    assert [r[1] for r in whitening.largest_roots([1, -13, 60, -112, 64], 4)] == [3, 1]  # (x - 4)^3 (x - 1)
    assert whitening.largest_roots([1, -6, 8, 0, 0], 4) == [(pytest.approx(Decimal(4)), 1), (pytest.approx(Decimal(2)), 1)]
    rng = np.random.default_rng(11)
    for d, n in ((1, 5), (3, 10), (12, 200), (8, 5)):
        x = np.floor(rng.normal(size=(n, d)) * 40).astype(int)
        found = whitening.components(*exact(x.tolist()))
        value, vector = np.linalg.eigh(np.cov(x.T, bias=True).reshape(d, d))
        value, vector = value[::-1], vector[:, ::-1]
        count = min(4, d, n - 1)
        assert len(found.scale) == count
        assert found.scale**2 == pytest.approx(value[:count]) and found.explained == pytest.approx(value[:count] / value.sum())
        assert np.abs((found.vectors * vector[:, :count].T).sum(axis=1)) == pytest.approx(np.ones(count), abs=1e-9)


def test_whitening_query(spark):
    rng = random.Random(12)
    rows = [(i, [rng.gauss(0, 1 / (k + 1)) for k in range(6)]) for i in range(60)]
    rows += [(100, rows[0][1]), (5, rows[5][1]), (None, [0.0] * 6), (101, [-0.0] * 6), (102, [1e300, 0.0, 0.0, 0.0, 0.0, 0.0])][:4]
    odd = [(200, None), (201, [None] + [0.0] * 5), (202, [math.nan] + [0.0] * 5), (203, [math.inf] * 6), (204, [1.0]), (205, [])]
    made = lambda r: spark.createDataFrame(r, "vec_id long, embedding array<double>").selectExpr("*", "1 as x", "2 as n", "3 as component")
    found = whitening.whiten(made(rows + odd))
    assert found.columns == "vec_id component n deviation whitened explained identity_error".split()
    x = {tuple(math.floor(256 * c) for c in v) for _, v in rows}
    n, s, m = exact(sorted(x))
    value, vector = np.linalg.eigh(np.array(m, float) / n**2)
    value, vector = value[::-1][:4], vector[:, ::-1][:, :4]
    got = collections.defaultdict(list)
    for r in sorted(found.collect(), key=lambda r: r.component):
        assert r.n == n and r.identity_error < 1e-9 and r.explained == pytest.approx(value[r.component - 1] * n**2 / sum(m[i][i] for i in range(6)))
        got[r.vec_id].append((r.component, r.deviation, r.whitened))
    assert set(got) == {i for i, _ in rows}
    for i, v in rows:
        own = [math.floor(256 * c) for c in v]
        w = (np.array(own) - np.array(s) / n) @ vector / np.sqrt(value)
        copies = sum(j == i for j, _ in rows)
        assert len(got[i]) == 4 * copies
        assert {g[1] for g in got[i]} == {sum((n * a - b) ** 2 for a, b in zip(own, s))}
        assert [abs(g[2]) for g in got[i][::copies]] == pytest.approx(np.abs(w).tolist(), rel=1e-6, abs=1e-9)
    assert whitening.whiten(made(odd[:4])).count() == 0 and whitening.whiten(made(rows).limit(0)).count() == 0
    assert whitening.whiten(made([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # no variance
    flat = whitening.whiten(made([(i, [float(i), 1.0, 0.0]) for i in range(5)])).collect()
    assert {r.component for r in flat} == {1} and {r.explained for r in flat} == {1.0}


def test_wide_entries_stay_exact():
    x = np.array([[3 << 40, 5], [-(1 << 41), 7], [1, -(1 << 30)]], np.int64)
    assert whitening._products(x).tolist() == [[sum(int(r[i]) * int(r[j]) for r in x) for j in range(2)] for i in range(2)]
    for v in (0, 1, -1, (1 << 130) + 5, -(1 << 133) + 9):
        assert sum(p << (40 * k) for k, p in enumerate(whitening._limbs(v))) == v
