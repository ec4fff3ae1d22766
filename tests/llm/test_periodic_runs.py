"""Periodic runs against a brute-force search over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from tenura.llm.periodic_runs import find_runs, periodic_runs, run_digests, with_planted_periods
from tenura.llm.queries import QUERIES


def runs_of(words, least=6, times=4):
    """Every run by its definition, period by period."""
    n, out = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            run = words[i : j + q]
            smaller = any(run[p:] == run[:-p] for p in range(1, q))
            if len(run) >= max(least, times * q) and not smaller:
                out.append((i, len(run), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_against_brute_force():
    draw = random.Random(1)
    for _ in range(1500):
        n, kinds = draw.randint(0, 60), draw.choice([1, 2, 2, 3, 5])
        words = [draw.randrange(kinds) for _ in range(n)]
        if n > 6 and draw.random() < 0.5:
            a = draw.randrange(n)
            p = 1 + (n - a) // draw.randint(3, 10)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        for least, times in ((6, 4), (2, 2)):
            found = find_runs(np.array(words, np.int64), least, times)
            assert list(zip(*(c.tolist() for c in found))) == runs_of(words, least, times)


def test_long_runs_take_no_longer_than_sorting():
    codes = np.concatenate([np.arange(30_000) % 7_000, np.full(200_000, 7_000)])
    assert [c.tolist() for c in find_runs(codes, 6, 4)] == [[0, 30_000], [30_000, 200_000], [7_000, 1]]


def test_query_against_brute_force(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op13_periodic_runs"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    planted = 0
    for row in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[row["doc_id"]] or "")
        h, n = zlib.crc32(str(row["doc_id"]).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            planted += 1
        runs = runs_of(words) if n < 3000 else None
        if runs is None:
            continue
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert row["runs_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(collapse(words, runs).encode()).hexdigest()
    assert planted


def test_odd_rows(spark):
    long = " ".join(["a", "b"] * 300_000)
    rows = [
        (1, None, "x"),
        (2, "", "x"),
        (3, " \t\n", "x"),
        (None, "a a a a a a b", "x"),
        (4, "one", "x"),
        (5, long, "x"),
        (6, "A a A a A a A a", "x"),
        (6, "A a A a A a A a", "x"),
        (7, "ä\u00a0ö ä\u00a0ö ä\u00a0ö ä\u00a0ö ä\u00a0ö ä\u00a0ö", "x"),
        (8, "s t " * 6, "x"),
        (9, "s t " * 6, "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = {}
    for r in periodic_runs(docs).collect():
        got.setdefault(r["doc_id"], []).append(([tuple(x) for x in r["runs"]], r["collapsed"]))
    assert got[1] == got[2] == got[3] == [([], "")]
    assert got[None] == [([(0, 6, 1)], "a b")]
    assert got[4] == [([], "one")]
    assert got[5] == [([(0, 600_000, 2)], "a b")]
    assert got[6] == [([(0, 8, 2)], "A a")] * 2
    assert got[7] == [([(0, 6, 1)], "ä\u00a0ö")]
    assert got[8] == got[9] == [([(0, 12, 2)], "s t")]  # two texts on end do not run on
    digests = run_digests(periodic_runs(docs)).where("doc_id = 1").first()
    empty = hashlib.sha256(b"").hexdigest()
    assert tuple(digests)[1:] == (0, None, None, None, None, empty, empty)
    assert with_planted_periods(docs).where(F.col("text").isNull()).count() == 1
    assert run_digests(periodic_runs(docs.limit(0))).count() == 0
