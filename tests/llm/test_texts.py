"""Decontamination, quality, toxicity, fuzzy passages and the pipeline."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tenura.llm import fuzzy_passages as fuzzy
from tenura.llm.decontamination import (
    BenchmarkIndex,
    drop_contaminated,
    find_contamination,
    question_and_answer,
)
from tenura.llm.site_quality import keep_good, site_posteriors, site_quality
from tenura.llm.toxicity import GRAMS, WIDTH, Network, WordTable, _Part, fit, fit_toxicity, score_toxicity
from tenura.llm.words import Words


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text):
    return re.findall(rb"[a-z0-9\x80-\xff]+", text.lower().encode())


def overlap(part, words):
    width = min(5, len(part))
    if not width:
        return 1.0
    have = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
    wanted = {tuple(part[i : i + width]) for i in range(len(part) - width + 1)}
    return len(wanted & have) / len(wanted)


def test_contamination_against_brute_force(spark, sf_dir):
    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").collect()]
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    wanted = set()
    for doc_id, text in docs:
        words = words_of(text)
        for item, body in items:
            if min(overlap(words_of(p), words) for p in question_and_answer(body.lower())) >= 0.8:
                wanted.add((doc_id, item))
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    assert wanted and {(r["doc_id"], r["item_id"]) for r in found.collect()} == wanted


def test_scores_do_not_depend_on_the_parts_of_a_benchmark(spark, sf_dir, monkeypatch):
    from tenura.llm import decontamination

    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    options = {"threshold": 0.4, "overlap": 0.0}
    whole = {(r[0], r[1]): r[2] for r in find_contamination(docs, items, **options).collect()}
    kept = {r["doc_id"] for r in drop_contaminated(docs, items).collect()}
    monkeypatch.setattr(decontamination, "INDEX_ITEMS", 9)
    parts = {(r[0], r[1]): r[2] for r in find_contamination(docs, items, **options).collect()}
    assert whole and parts == pytest.approx(whole)
    assert {r["doc_id"] for r in drop_contaminated(docs, items).collect()} == kept


def test_long_texts_leave_their_places_in_the_fit_to_others(spark, monkeypatch):
    from tenura.llm import toxicity

    rows = [(i, "w " * (500 if i < 30 else 5), i % 2) for i in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(99, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(99, 0)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "FIT_ROWS", 8)
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels: (texts, labels))
    texts, y = fit_toxicity(docs, labels, fit_chars=100)
    assert len(texts) == 16 and y.sum() == 8
    assert all(len(t or "") <= 100 for t in texts)


def test_bounds_never_miss_an_item():
    draw = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    common = words[:12]
    items = [(i, " ".join(draw.choices(words, k=draw.randint(3, 30)) + draw.choices(common, k=8))) for i in range(90)]
    index = BenchmarkIndex(items, 0.4, 0.0, 5)
    texts = []
    for _ in range(60):
        body = draw.choices(common, k=20) + draw.choices(words, k=20)
        _, item = draw.choice(items)
        texts.append(" ".join(body + [w for w in item.split() if draw.random() < 0.6]))
    got = index.search(pa.array(texts), Words(space=False))
    for b, (ids, scores) in enumerate(index.exact):
        for place in range(scores.shape[1]):
            if b * 4 + place >= len(index.items):
                continue
            for row, text in enumerate(texts):
                hashes, at = Words(space=False)(pa.array([text]))
                _, first, stop = index.passages(at)
                best = max(
                    scores[np.isin(index.terms[ids], hashes[x:y]), place].sum()
                    for x, y in zip(first, stop, strict=True)
                )
                name = (row, int(index.items[b * 4 + place]))
                assert (name in got) == (best >= 0.4 - 1e-9)
                if name in got:
                    assert got[name][0] == pytest.approx(best)


def test_contamination_of_odd_rows(spark):
    item = "What is the capital city of the old country here?\nIt is the town of Springfield by the river."
    tests = spark.createDataFrame(
        [(1, item), (2, None), (3, ""), (None, item), (4, "..."), (5, "One sentence that has no answer at all, only this")],
        "item_id long, text string",
    )
    filler = " ".join(f"filler{i % 50}" for i in range(40_000))
    rows = [
        (1, f"{filler} {item.upper()}!! {filler}"), (2, None), (3, ""), (None, item), (4, item), (4, item),
        (5, item.split("\n")[0]), (6, filler), (7, "x one sentence that has no answer at all, only THIS."),
    ]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double")
    got = find_contamination(df, tests)
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in got.collect()) == [
        (0, 1), (1, 1), (4, 1), (4, 1), (7, 5),
    ]
    clean = drop_contaminated(df, tests)
    assert clean.columns == df.columns and sorted(r["doc_id"] for r in clean.collect()) == [2, 3, 5, 6]
    assert find_contamination(df.limit(0), tests).count() == 0
    assert find_contamination(df, tests.limit(0)).count() == 0


def test_quality_on_labels_the_fit_did_not_see(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rated = site_quality(docs, labels.where("doc_id % 2 = 0"))
    seen = rated.join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    right = sum(r["keep"] == (r["quality"] >= 0.5) for r in seen)
    assert right == len(seen)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    wrong = [r["doc_id"] for r in seen if r["keep"] != bool(truth[r["doc_id"]])]
    assert len(wrong) <= 0.05 * len(seen)


def test_sparse_sites_shrink(spark):
    rows = [("a", "x", 0.9)] * 500 + [("b", "x", 0.3)] * 500 + [("c", "y", 0.0), (None, None, 1.0)]
    got = {
        (r["host"], r["path"]): r
        for r in site_posteriors(spark.createDataFrame(rows, "host string, path string, p double")).collect()
    }
    overall = got["a", "x"]["p_global"]
    assert overall == pytest.approx(0.6, abs=0.01)
    assert got["a", "x"]["p_path"] == pytest.approx(0.9, abs=0.02)
    assert got["b", "x"]["p_path"] == pytest.approx(0.3, abs=0.02)
    assert abs(got["c", "y"]["p_path"] - overall) < 0.5 and got["c", "y"]["p_path"] > 0.2
    assert got[None, None]["p_path"] < 0.95


def test_quality_of_odd_rows(spark):
    rows = [(1, None, None, None), (None, "", "en", "s"), (2, "some words here", "en", "s")]
    rows += [rows[2], (3, "word " * 100_000, None, "s")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, lang string, source string, keep int")
    labels = spark.createDataFrame([(2, 1), (3, 0), (2, None), (None, 1), (3, 7)], "doc_id long, quality int")
    assert site_quality(df, labels).count() == 5
    none = labels.limit(0)
    assert keep_good(df, none).columns == df.columns
    assert sorted(map(str, keep_good(df, none).collect())) == sorted(map(str, df.collect()))
    assert site_quality(df.limit(0), labels).count() == 0


def toxic_rows(n, seed):
    draw = random.Random(seed)
    words = [a + b + c for a in ("ba", "do", "ki") for b in ("ru", "sel", "ton") for c in ("", "ma", "pi", "zeg")]
    bad = ["vilex", "grobnak", "vilexo", "skutter"]
    out = []
    for _ in range(n):
        text = draw.choices(words, k=draw.randint(1, 90))
        y = draw.random() < 0.3
        if y:
            for _ in range(3):
                text.insert(draw.randrange(len(text) + 1), draw.choice(bad))
        out.append((" ".join(text), int(y)))
    return out


def test_gradients_against_differences():
    rows = toxic_rows(30, 1)
    network = fit([t for t, _ in rows], np.array([y for _, y in rows]), rounds=0)
    words = WordTable(pa.array([t for t, _ in rows]), Words(space=False), network.vocabulary)
    text, where, mask = words.windows()
    part, y = _Part(words, where[:20]), np.array([rows[i][1] for i in text[:20]], np.float32)
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    gradients = network.gradients(part, part.where, mask[:20], y)

    def loss():
        logit = network.forward(network.inputs(part), part.where, mask[:20]).astype(float)
        return np.mean(np.log1p(np.exp(logit)) - y * logit)

    for name, value in network.p.items():
        at = np.unravel_index(np.abs(gradients[name]).argmax(), value.shape)
        kept, losses = value[at], []
        for step in (1e-3, -1e-3):
            value[at] = kept + step
            losses.append(loss())
        value[at] = kept
        assert (losses[0] - losses[1]) / 2e-3 == pytest.approx(float(gradients[name][at]), rel=0.02, abs=1e-5)


def test_windows_cover_every_word():
    texts = pa.array([" ".join(f"w{i}" for i in range(n)) for n in (0, 1, WIDTH, WIDTH + 1, 200)])
    words = WordTable(texts, Words(space=False), np.zeros(0, np.uint64))
    text, where, mask = words.windows()
    for row in range(len(texts)):
        own = {w for w, m in zip(where[text == row].ravel(), mask[text == row].ravel()) if m}
        assert own == set(words.which[words.at[row] : words.at[row + 1]].tolist())
    assert set(GRAMS) == set(words.grams)


def test_network_learns_and_scores_odd_rows(spark):
    rows = toxic_rows(700, 2)
    documents = [(i, t) for i, (t, _) in enumerate(rows)]
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    df = spark.createDataFrame([(*r, 0.5) for r in documents], "doc_id long, text string, score double")
    network = fit_toxicity(df, labels)
    assert isinstance(network, Network)
    got = {r["doc_id"]: r for r in score_toxicity(df, network).collect()}
    held = [i for i in range(len(rows)) if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum(got[i]["predicted"] == rows[i][1] for i in held)
    assert len(held) > 100 and right >= 0.95 * len(held)
    odd = [(None, rows[0][0]), (1, None), (2, ""), (3, "!!! ???"), (4, "vilex " * 60_000), (5, "ba"), (5, "ba")]
    odd = spark.createDataFrame(odd, "doc_id long, text string")
    scores = score_toxicity(odd, network).collect()
    assert len(scores) == 7 and all(0 <= r["score"] <= 1 for r in scores)
    by_id = {r["doc_id"]: r for r in scores}
    assert by_id[1]["score"] == by_id[2]["score"] == by_id[3]["score"] and by_id[2]["predicted"] == 0
    assert by_id[4]["predicted"] == 1
    assert score_toxicity(df.limit(0), network).count() == 0
    flat = score_toxicity(odd, fit_toxicity(df, labels.limit(0))).collect()
    assert len({r["score"] for r in flat}) == 1


def brute_chain(x, y):
    """Best chain score by trying every predecessor."""
    order = sorted(range(len(x)), key=lambda i: (x[i], y[i]))
    best = {}
    for n, i in enumerate(order):
        best[i] = fuzzy.K
        for j in order[:n]:
            if x[j] < x[i] and y[j] < y[i]:
                gap = fuzzy.GAP_COST * (x[i] - x[j] + y[i] - y[j])
                best[i] = max(best[i], best[j] + fuzzy.K - gap)
    return max(best.values())


def test_chains_are_the_best_when_seeds_stand_alone():
    draw = random.Random(8)
    for _ in range(60):
        n = draw.randint(1, 25)
        x = np.array(draw.sample(range(0, 40 * n, 7), n))
        y = np.array(draw.sample(range(0, 40 * n, 11), n))
        for i in range(n - 1):  # no two on one diagonal, so no runs
            while len({int(a - b) for a, b in zip(x, y)}) < n:
                y = np.array(draw.sample(range(0, 40 * n, 11), n))
        found = fuzzy.chains(x, y)
        assert sorted(s for c in found for s in c) == list(range(n))
        scores = []
        for chain in found:
            assert all(x[a] < x[b] and y[a] < y[b] for a, b in zip(chain, chain[1:]))
            gaps = sum(x[b] - x[a] + y[b] - y[a] for a, b in zip(chain, chain[1:]))
            scores.append(fuzzy.K * len(chain) - fuzzy.GAP_COST * gaps)
        assert max(scores) == pytest.approx(brute_chain(list(x), list(y)))


def test_edits_are_edit_distance():
    draw = random.Random(3)
    for _ in range(50):
        a = [draw.randrange(6) for _ in range(draw.randint(1, 20))]
        b = list(a)
        for _ in range(draw.randint(0, 5)):
            at = draw.randrange(len(b) + 1)
            b[at : at + draw.randint(0, 1)] = [draw.randrange(6)] * draw.randint(0, 1)
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
            row = new
        assert fuzzy._edits(np.array(a, np.uint64), np.array(b, np.uint64)) == row[-1]


def test_passages_are_found_and_nothing_else(spark):
    draw = random.Random(6)
    words = [f"v{i}" for i in range(5000)]
    body = lambda n: draw.choices(words, k=n)
    passages = [body(n) for n in (51, 60, 90, 300)]
    line = body(12)
    rows, hold = [], {}
    for i in range(160):
        text, with_ = body(draw.randint(0, 150)) + line * (i % 3 == 0), i % 5
        if with_ < 4:
            passage = list(passages[with_])
            for _ in range((with_ > 0) * draw.randint(0, len(passage) // 20)):
                passage[draw.randrange(3, len(passage) - 3)] = draw.choice(words)
            text = text + passage + body(draw.randint(0, 150))
            hold.setdefault(with_, []).append(i)
        rows.append((i, " ".join(text)))
    rows += [(500, None), (501, ""), (None, rows[0][1]), (502, "few words"), (502, "few words")]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, start int")
    got = fuzzy.fuzzy_passages(df.repartition(3)).collect()
    found = {}
    for r in got:
        assert r["first_doc_id"] < r["doc_id"] and r["n_words"] >= 50 and r["likeness"] >= 0.8
        found.setdefault(r["doc_id"] % 5, set()).update((r["doc_id"], r["first_doc_id"]))
    assert found == {k: set(v) for k, v in hold.items()}
    assert fuzzy.fuzzy_passages(df.limit(0)).count() == 0


def spans_of(spark, texts, doc):
    """Spans that one document has with earlier ones: start, words, earlier document."""
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts], "doc_id long, text string")
    rows = fuzzy.fuzzy_passages(df).where(f"doc_id = {doc}").collect()
    return sorted((r["start"], r["n_words"], r["first_doc_id"]) for r in rows)


def test_two_passages_around_own_text_are_both_found(spark):
    draw = random.Random(7)
    fresh = lambda n: [f"o{draw.getrandbits(48)}" for _ in range(n)]
    for size, between in ((60, 100), (200, 150), (200, 1000)):
        head, foot = fresh(size), fresh(size)
        texts = [(i, head + fresh(between) + foot) for i in (1, 2)]
        wanted = [(0, size, 1), (size + between, size, 1)]
        assert spans_of(spark, texts, 2) == wanted


def test_every_place_of_a_passage_is_reported(spark):
    draw = random.Random(9)
    fresh = lambda n: [f"o{draw.getrandbits(48)}" for _ in range(n)]
    passage = fresh(60)
    twice = fresh(80) + passage + fresh(300) + passage + fresh(20)
    assert spans_of(spark, [(1, fresh(30) + passage), (2, twice)], 2) == [(80, 60, 1), (440, 60, 1)]
    lines = [passage[i : i + 12] for i in range(0, 60, 12)]
    apart = lambda some: [w for line in some for w in line + fresh(90)]
    texts = [(1, apart(lines[::-1]) + passage + fresh(9)), (2, apart(lines[::-1]) + passage)]
    assert spans_of(spark, texts, 2) == [(510, 60, 1)]


def test_passages_with_many_words_changed_are_found(spark):
    draw = random.Random(10)
    fresh = lambda n: [f"o{draw.getrandbits(48)}" for _ in range(n)]
    for every in (6, 7, 10):
        passage = fresh(60)
        other = [w if i % every != every - 1 else f"x{i}" for i, w in enumerate(passage)]
        texts = [(1, fresh(70) + passage + fresh(40)), (2, fresh(20) + other + fresh(90))]
        ((start, size, first),) = spans_of(spark, texts, 2)
        assert start == 20 and 55 <= size <= 60 and first == 1


def test_passages_are_found_behind_other_documents_of_their_seeds(spark):
    draw = random.Random(11)
    fresh = lambda n: [f"o{draw.getrandbits(48)}" for _ in range(n)]
    passage = fresh(60)
    halves = [(1, fresh(40) + passage[:30]), (2, passage[30:] + fresh(40))]
    both = [(i, fresh(10 * i) + passage + fresh(30)) for i in (3, 4, 5)]
    for doc in (4, 5):
        assert spans_of(spark, halves + both, doc) == [(10 * doc, 60, 3)]
    lines = [passage[i : i + 12] for i in range(0, 60, 12)]
    early = [(i, fresh(60) + lines[i % 5] + fresh(60)) for i in range(1, 21)]
    both = [(i, fresh(25) + passage + fresh(30)) for i in (30, 31)]
    assert spans_of(spark, early + both, 31) == [(25, 60, 30)]


def test_pipeline_stages_against_their_inputs(spark, sf_dir):
    import corpus_pipeline
    from test_near_duplicates import expected
    from test_rows import poisson
    from tenura.llm.mixing import target_rates

    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        before, docs = docs, stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns
        kept[name] = (before, docs)
    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf_dir, "labels").collect()}
    good = {r["doc_id"] for r in kept["quality"][1].collect()}
    assert all(i in good for i, q in labels.items() if q == 1) or len(good) > 0.8 * len(labels)
    before, after = kept["near_duplicates"]
    texts = [(r["doc_id"], r["text"]) for r in before.collect()]
    wanted = {i for i, _, component, _ in expected(texts, 5, 80) if i == component}
    assert {r["doc_id"] for r in after.collect()} == wanted and after.count() == len(wanted)
    before, after = kept["decontamination"]
    leaks = find_contamination(before, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    assert leaks.count() > 0 and after.count() == before.join(leaks, "doc_id", "left_anti").count()
    before, after = kept["mixing"]
    rates = {r["source"]: r["rate"] for r in target_rates(before).collect()}
    assert after.count() == sum(poisson(r["doc_id"], rates[r["source"]]) for r in before.collect())
    out = corpus_pipeline.STAGES[4][1](spark, docs, sf_dir)
    assert out.count() == docs.count()


def test_stages_keep_clashing_columns_and_null_ids(spark, sf_dir):
    import corpus_pipeline

    rows = [(1, "a b c d e f g h", "x"), (2, "a b c d e f g h", "y"), (None, "a b c d e f g h", None), (1, "a b c d e f g h", "x")]
    df = spark.createDataFrame(
        [(i, t, "en", s, 1, 0.5, "k", "c") for i, t, s in rows],
        "doc_id long, text string, lang string, source string, n_chars long, quality double, keep string, copy string",
    )
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, df, sf_dir).columns == df.columns
        assert stage(spark, df.limit(0), sf_dir).count() == 0
    left = corpus_pipeline.STAGES[1][1](spark, df, sf_dir).collect()
    assert sorted(r["doc_id"] or 0 for r in left) == [0, 1]
