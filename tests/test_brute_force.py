"""Random small cases, many at once, against plain Python."""

import random
from collections import defaultdict

import pytest

from tenura.operators import metrics, profile, quality
from tenura.operators.quality import INTEGER, InputColumn


def cases(seed=5, n=40):
    rng = random.Random(seed)
    for c in range(n):
        size, levels = rng.randint(1, 60), rng.choice([1, 2, 3, 10, 1000])
        share = rng.choice([0.0, 0.1, 0.5, 1.0])
        yield (
            f"c{c:02d}",
            [
                (f"i{rng.random():.9f}", int(rng.random() < share), rng.randint(0, levels) / levels)
                for _ in range(size)
            ],
        )


def expected(rows, fraction):
    ordered = sorted(rows, key=lambda r: (-r[2], r[0]))
    n, positives = len(rows), sum(r[1] for r in rows)
    k = max(1, round(n * fraction))
    tp = sum(r[1] for r in ordered[:k])
    precision, recall = tp / k, tp / positives if positives else 0.0
    groups = defaultdict(list)
    for _, y, s in rows:
        groups[s].append(y)
    seen = hits = 0
    ap = 0.0
    for s in sorted(groups, reverse=True):
        seen += len(groups[s])
        hits += sum(groups[s])
        ap += sum(groups[s]) * hits / seen
    return {
        "k": k,
        "tp": tp,
        "fp": k - tp,
        "fn": positives - tp,
        "tn": n - k - positives + tp,
        "precision": precision,
        "recall": recall,
        "f1": 2 * precision * recall / (precision + recall) if precision + recall else 0.0,
        "lift": precision / (positives / n) if positives else None,
        "pr_auc": ap / positives if positives else None,
        "brier_score": sum((s - y) ** 2 for _, y, s in rows) / n,
    }


def test_metrics(spark):
    data = dict(cases())
    rows = [(c, *r) for c, rs in data.items() for r in rs]
    df = spark.createDataFrame(rows, "candidate STRING, id STRING, y INT, score DOUBLE")
    fractions = [0.05, 0.25, 0.5, 1.0]
    found = metrics.evaluate(df.repartition(7), fractions).collect()
    assert len(found) == len(data) * len(fractions)
    for row in found:
        for name, value in expected(data[row.candidate], row.k_frac).items():
            where = (row.candidate, row.k_frac, name)
            if value is None:
                assert row[name] is None, where
            else:
                assert row[name] == pytest.approx(value, abs=1e-12), where


def test_histogram(spark):
    rng = random.Random(11)
    values = [rng.choice([rng.uniform(-5, 5), float(rng.randint(-3, 3))]) for _ in range(800)]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    low, high = min(values), max(values)
    counts = [0] * 30
    for v in values:
        counts[min(29, int((v - low) * 30 / (high - low)))] += 1
    found = profile.histogram(df, "v").orderBy("bin").collect()
    assert [r.n_rows for r in found] == counts


def test_value_rules(spark):
    """Counts and smallest ids of broken rules on random rows with a third of them broken."""
    rng = random.Random(3)
    rows, wrong = [], defaultdict(list)
    for i in range(900):
        key, value = f"k{rng.randint(0, 10**9)}-{i}", float(rng.randint(0, 9))
        kind = rng.choice(["ok", "ok", "null_not_allowed", "nan", "infinite", "not_whole"])
        value = {
            "null_not_allowed": None,
            "nan": float("nan"),
            "infinite": float("-inf"),
            "not_whole": value + 0.25,
        }.get(kind, value)
        if kind != "ok":
            wrong[kind].append(key)
        rows.append((key, value))
    df = spark.createDataFrame(rows, "id STRING, x DOUBLE")
    found = quality.report(df, "id", [InputColumn("x", INTEGER)]).collect()
    assert {(r.rule, r.offending, r.first_id) for r in found} == {
        (rule, len(keys), min(keys)) for rule, keys in wrong.items()
    }
    assert [r.rule for r in found if r.is_first] == ["null_not_allowed"]
