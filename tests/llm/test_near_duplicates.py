"""Near duplicates against brute force, and the defined results of odd input."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from tenura.llm.components import components
from tenura.llm.near_duplicates import forest, near_duplicates
from tenura.llm.words import Words, shingles


def sets_of(texts, width):
    out = {}
    for doc_id, text in texts:
        words = (text or "").encode().lower().split()
        if len(words) >= width:
            out[doc_id] = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
        else:
            out[doc_id] = {tuple(words)} if words else set()
    return out


def groups(ids, links):
    root = {i: i for i in ids}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def expected(texts, width, percent):
    sets = sets_of(texts, width)
    links = [
        (a, b)
        for a, b in combinations(sets, 2)
        if sets[a] and sets[b]
        and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    component = groups(sets, links)
    return {(i, len(sets[i]), component[i], component[i] == i) for i in sets}


def corpus(seed, groups_=12, size=9):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(groups_):
        base = draw.choices(words, k=draw.randint(20, 120))
        for _ in range(size):
            text = list(base)
            for _ in range(draw.randint(0, 4)):
                text[draw.randrange(len(text))] = draw.choice(words)
            texts.append(" ".join(text))
    texts += [" ".join(draw.choices(words, k=draw.randint(1, 60))) for _ in range(60)]
    draw.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_against_all_pairs(spark, width, percent):
    texts = corpus(width)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = near_duplicates(df, width=width, percent=percent)
    assert {tuple(r) for r in got.collect()} == expected(texts, width, percent)


def test_large_nodes_branch_and_still_find_all(spark, monkeypatch):
    from tenura.llm import near_duplicates as module

    monkeypatch.setattr(module, "LEAF", 4)
    texts = corpus(9, groups_=3, size=40)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = near_duplicates(df, width=3, percent=85)
    assert {tuple(r) for r in got.collect()} == expected(texts, 3, 85)


def test_odd_rows(spark):
    long_text = " ".join(f"x{i % 977}" for i in range(30_000))
    rows = [
        (5, "A b\tC"), (3, "a B c"), (9, "a b"), (8, "A B"), (1, None), (2, ""), (4, " \n\t"),
        (6, long_text), (7, long_text + " end"), (None, "a b c"), (11, "é É"), (12, "é é"),
    ]
    df = spark.createDataFrame(
        [(*r, "node", 0) for r in rows], "doc_id long, text string, rep string, component_id int"
    )
    got = {r["doc_id"]: tuple(r)[1:] for r in near_duplicates(df, width=3, percent=85).collect()}
    assert got[3] == (1, 3, True) and got[5] == (1, 3, False)
    assert got[8] == (1, 8, True) and got[9] == (1, 8, False)
    assert got[1] == got[2][:1] + (1, True) and got[2] == (0, 2, True) and got[4] == (0, 4, True)
    assert got[7] == (978, 6, False)
    assert got[None] == (1, None, True)
    assert got[11] == (1, 11, True) and got[12] == (1, 12, True)


def test_empty_table_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).count() == 0
    twice = spark.createDataFrame([(4, "a b c d e f")] * 2 + [(2, "a b c d e f")], empty.schema)
    assert sorted(tuple(r) for r in near_duplicates(twice).collect()) == [
        (2, 2, 2, True), (4, 2, 2, False), (4, 2, 2, False),
    ]


def test_forest_joins_only_what_is_not_joined():
    sets = [np.array([1, 2, 3], np.uint64), np.array([1, 2, 3, 4], np.uint64),
            np.array([2, 3, 4], np.uint64), np.array([9], np.uint64)]
    assert len(forest(sets, [0, 1, 2, 3], 70)) == 2
    assert forest(sets, [0, 0, 0, 3], 70) == []


def test_words_are_those_of_bytes_split():
    texts = ["A bB\x0bc\x1cd", "", None, "é\xa0É x", " ", "z" * 3_000_000 + " y"]
    hashes, at = Words()(pa.array(texts))
    for text, a, b in zip(texts, at[:-1], at[1:], strict=True):
        assert b - a == len((text or "").encode().lower().split())
    assert Words()(pa.array(["ab AB"]))[0][0] == Words()(pa.array(["x ab"]))[0][1]
    assert shingles(hashes, at, 3)[1][-1] == sum(
        max(len(w) - 2, 1) for w in ((t or "").encode().split() for t in texts) if w
    )


def test_components_of_paths_stars_and_self_links(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(1000, 1100)]
    edges = spark.createDataFrame(path + star + [(5, 5)] + star, "a long, b long")
    got = {r["id"]: r["component_id"] for r in components(edges).collect()}
    assert got == {
        **{i: 100 for i in range(100, 161)}, **{i: 7 for i in range(1000, 1100)}, 7: 7, 5: 5,
    }
