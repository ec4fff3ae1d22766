"""Ranked search against scores of every pair of item and document."""

import math
import random
import re
from collections import Counter

import pytest

from tenura.llm import ranked_search as module
from tenura.llm.ranked_search import ranked_search

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, limit):
    lists = [(i, re.findall(TERM, (t or "").translate(LOWER))) for i, t in docs]
    lists = [(i, words) for i, words in lists if words]
    n, total = len(lists), sum(len(words) for _, words in lists)
    df = Counter(t for _, words in lists for t in set(words))
    counted = [(i, len(words), Counter(words)) for i, words in lists if i is not None]
    wanted = {}
    for item, text in items:
        if item is not None:
            wanted.setdefault(item, set()).update(re.findall(TERM, (text or "").translate(LOWER)))
    out = []
    for item, terms in wanted.items():
        scores = []
        for doc, length, tf in counted:
            m = 50 + (50 * length * n) // total
            score = 0
            for t in terms & tf.keys():
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 20 * m))
            if score > 0:
                scores.append((-score, doc))
        out += [(item, k + 1, doc, -s) for k, (s, doc) in enumerate(sorted(scores)[:limit])]
    return sorted(out)


def rows_of(found):
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("bucket, block, parts", [(2048, 500_000, 1), (16, 500_000, 9), (7, 60, 5)])
def test_search_against_brute_force(spark, monkeypatch, bucket, block, parts):
    monkeypatch.setattr(module, "BUCKET", bucket)
    monkeypatch.setattr(module, "BLOCK_TERMS", block)
    draw = random.Random(bucket)
    words = [f"w{i}" for i in range(150)] + ["É", "Straße", "x9"]
    odds = [1 / (i + 1) for i in range(len(words))]
    docs = []
    for i in range(600):
        text = " ".join(draw.choices(words, odds, k=draw.choice([1, 5, 30, 200])))
        docs += [(i * 3, text.upper() if i % 7 == 0 else text)]
    docs += [(5000 + i, docs[3][1]) for i in range(150)]  # copies tie
    items = [(i, " ".join(draw.sample(words, k=draw.randint(1, 25)))) for i in range(20)]
    found = ranked_search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(parts),
        spark.createDataFrame(items, "item_id long, text string"),
        limit=20,
    )
    assert rows_of(found) == brute(docs, items, 20)


def test_bounds_prune(spark):
    """A vector that the bounds leave out has no score that counts, and most are left out."""
    import numpy as np
    import pyarrow as pa

    draw = np.random.default_rng(2)
    weights = np.sort(draw.integers(1, 9000, 200))
    roots = np.sqrt(weights)
    terms = [np.sort(draw.choice(200, draw.integers(1, 30), replace=False)) for _ in range(500)]
    impacts = [draw.integers(1, 10**6, len(t)) for t in terms]
    norms = [float(np.sqrt((weights[t] * i.astype(float) ** 2).sum())) for t, i in zip(terms, impacts, strict=True)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(500)), pa.array(norms), pa.array(terms, pa.list_(pa.int32())), pa.array(impacts, pa.list_(pa.int64()))],
        names=["doc", "norm", "terms", "impacts"],
    )
    bucket, left = module._Bucket(batch, roots), 0
    for _ in range(50):
        item = module._Item(np.sort(draw.choice(200, 12, replace=False)), weights, 0)
        every = bucket.scores(item, np.ones(500, bool))
        item.least = int(np.sort(every)[-20])
        rows = bucket.survivors(item, roots)
        assert rows[every >= item.least].all()
        assert (bucket.scores(item, rows)[rows] == every[rows]).all()
        left += rows.sum()
    assert left < 0.9 * 50 * 500


def test_odd_rows(spark):
    docs = [
        (1, None, 5),
        (2, "", 5),
        (3, "?! --", 5),
        (4, "apple pie", 5),
        (4, "apple pie", 5),
        (None, "apple apple", 5),
        (5, "Apple " + "filler " * 200_000, 5),
        (6, "plum", 5),
        (7, "nothing here", 5),
    ]
    items = [(1, "APPLE"), (2, None), (3, ""), (None, "apple"), (4, "pie"), (4, "plum plum"), (5, "zebra")]
    frames = (
        spark.createDataFrame(docs, "doc_id long, text string, item_id int"),
        spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS score"),
    )
    kept = [(i, t) for i, t, _ in docs]
    assert rows_of(ranked_search(*frames)) == brute(kept, items, 50)
    assert rows_of(ranked_search(frames[0], frames[1].limit(0))) == []
    assert rows_of(ranked_search(frames[0].limit(0), frames[1])) == []
