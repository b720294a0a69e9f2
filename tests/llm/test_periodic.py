"""Periodic runs against brute force: every lag of every text."""

import binascii
import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.llm import periodic

NONSPACE = re.compile(r"[^\x20\x09-\x0D]+")


def brute(x, shortest=12):
    """(start, length, period) by start, then period."""
    of = {}
    for q in range(1, len(x) // 2 + 1):
        i = q
        while i < len(x):
            j = i
            while j < len(x) and x[j] == x[j - q]:
                j += 1
            if j - i >= q and j - i + q >= shortest:
                of.setdefault((i - q, j), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in of.items()), key=lambda r: (r[0], r[2]))


def collapsed(ws, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(ws) if i not in dropped)


def sequence(r):
    """Texts full of runs: random over few words, Fibonacci words, Thue-Morse words, nested repetitions."""
    k, kind, x = r.choice([1, 2, 2, 3, 5]), r.randrange(4), []
    if kind == 0:
        return [r.randrange(k) for _ in range(r.randrange(200))]
    if kind == 1:
        a, b = [0], [0, 1]
        while len(b) < r.randrange(20, 400):
            a, b = b, b + a
        return b + b[: r.randrange(len(b))]
    if kind == 2:
        return [bin(i).count("1") % 2 for i in range(r.randrange(10, 300))]
    while len(x) < r.randrange(20, 300):
        u = [r.randrange(k) for _ in range(r.randrange(1, 30))]
        x += u * r.randrange(1, 6) + u[: r.randrange(len(u) + 1)]
        if r.random() < 0.3:
            x += x[-r.randrange(1, len(x) + 1) :]
    return x[:600]


@pytest.mark.parametrize("seed", range(6))
def test_runs_by_every_lag(seed):
    r = random.Random(seed)
    for _ in range(60):
        own = [sequence(r) for _ in range(3)]
        flat = np.array([v for x in own for v in x], dtype=np.int64)
        got = periodic.find_runs(flat, np.repeat(np.arange(3), [len(x) for x in own])) if len(flat) else np.zeros((0, 3))
        want, first = [], 0
        for x in own:
            want += [(s + first, s + n + first, q) for s, n, q in brute(x)]
            first += len(x)
        assert [tuple(map(int, v)) for v in got] == want


def test_touching_runs():
    """ababa...ababa...: every shift by a period is a run of its own, found by arithmetic only."""
    x = ([0, 1] * 20 + [0]) * 2
    assert [(s, e - s, q) for s, e, q in periodic.find_runs(np.array(x), np.zeros(len(x), int)).tolist()] == brute(x)


@pytest.mark.parametrize("x", [np.zeros(400_000, int), np.r_[np.zeros(200_000, int), 1, np.zeros(200_000, int)], np.r_[np.arange(200_001) % 2, np.arange(200_001) % 2], np.minimum(np.random.default_rng(1).zipf(1.2, 400_000), 9999)], ids=["one word", "one word, cut", "two long runs", "frequent words"])
def test_long_texts_cost_little(x):
    began = time.time()
    periodic.find_runs(x, np.zeros(len(x), int))
    assert time.time() - began < 30


def test_hash_collisions_are_seen():
    from waymark.llm.textbytes import AS_IS, NON_SPACE, words
    import pyarrow as pa

    (w,) = words(pa.array(["a b a c ab A a"]), NON_SPACE, case=AS_IS)
    w.hash[:] = 7
    assert len(set(periodic._word_numbers(w).tolist())) == 5


def test_operator(spark):
    r = random.Random(9)
    texts = [None, "", " \n\t", "one", "a " * 12, "a " * 11, "A a " * 6 + "a", "é ü\x0bé x é", "x　y z " * 7, "word " * 50_000]
    texts += [" ".join(f"w{v}" for v in sequence(r)) for _ in range(40)]
    rows = [(i, t, "extra", i) for i, t in enumerate(texts)] + [(None, "b " * 13, "", 0), (3, "c " * 14, "", 0), (3, "c " * 14, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, collapsed int").repartition(3)
    got = [(d, n, [tuple(x) for x in runs], text) for d, n, runs, text in periodic.periodic_runs(docs).collect()]
    want = []
    for i, t, *_ in rows:
        ws = NONSPACE.findall(t or "")
        runs = [(0, len(ws), 1)] if len(ws) > 1000 else brute(ws)
        want.append((i, len(ws), runs, collapsed(ws, runs)))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert periodic.periodic_runs(docs.limit(0)).collect() == []


def test_query_by_brute_force(spark, tmp_path):
    r = random.Random(4)
    rows = [(i, " ".join(r.choices("abcdefgh", k=r.randrange(60)))) for i in range(150)] + [(1000, None), (1001, ""), (None, "z " * 20)]
    rows += [(i, "  x\ny\t" * r.randrange(30)) for i in range(2000, 2040)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: tuple(x)[1:] for x in periodic.op12_periodic_runs(spark, str(tmp_path)).collect()}
    planted = 0
    for i, t in rows:
        ws = NONSPACE.findall(t or "")
        n, h = len(ws), None if i is None else binascii.crc32(str(i).encode())
        if n and h is not None and h % 10 == 0:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            ws = [ws[a + (k - a) % p] if k >= a else ws[k] for k in range(n)]
            planted += 1
        runs = brute(ws)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{m},{q}\n" for s, m, q in runs), collapsed(ws, runs))]
        assert got[i] == (len(runs), *best, best[1] and 1000 * best[1] // best[2], *digest), i
    assert planted > 5 and len(got) == len(rows)
    assert periodic.op12_periodic_runs(spark, str(tmp_path)).where(F.col("doc_id").isNull()).count() == 1
