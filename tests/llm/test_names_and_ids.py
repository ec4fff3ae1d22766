"""Columns with clashing names, and ids with several texts."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tenura.llm.mixing import mix
from tenura.llm.near_duplicates import near_duplicates
from tenura.llm.queries import vocabulary_path
from tenura.llm.site_quality import keep_good, site_quality
from tenura.llm.token_files import TextEncoder

CLASHES = ["_copies", "_copy", "_draws", "_cumulative", "_key", "rate", "mean", "_rate_source", "_q_text", "_q_document"]
CLASHES += ["_q_host", "p", "host", "path", "a`b", "_in0", "_in7"]


def clashing(spark):
    docs = [(i, f"some words of text {i % 7}", "en", "ab"[i % 2]) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    return frame.select("*", *[F.lit(777).alias(c) for c in CLASHES])


def test_mixing_keeps_columns_of_any_name(spark):
    frame = clashing(spark)
    mixed = mix(frame)
    assert mixed.columns == [*frame.columns, "copy", "shuffle_key"]
    rows = mixed.collect()
    assert rows and all(r[c] == 777 for r in rows for c in CLASHES)
    plain = mix(frame.drop(*CLASHES))
    assert sorted((r["doc_id"], r["copy"]) for r in rows) == sorted((r["doc_id"], r["copy"]) for r in plain.collect())


def test_quality_keeps_columns_of_any_name(spark):
    frame = clashing(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    rated = site_quality(frame, labels).collect()
    assert len(rated) == 40 and all(r[c] == 777 for r in rated for c in CLASHES if c not in ("quality",))
    assert keep_good(frame, labels).columns == frame.columns


def components_by_hand(rows, width, percent):
    """Ids joined by similar texts, whatever text of an id it is."""
    ids, sets = [r[0] for r in rows], []
    for _, text in rows:
        words = text.lower().split()
        sets.append({tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))})
    parent = {i: i for i in ids}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both, either = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if 100 * both >= percent * either:
                a, b = sorted((top(ids[i]), top(ids[j])))
                parent[b] = a
    return {i: top(i) for i in ids}


def test_an_id_with_two_texts_keeps_the_links_of_both(spark):
    draw, rows = random.Random(5), []
    for k in range(20):
        one, two = ([f"w{draw.randrange(10**6)}" for _ in range(60)] for _ in range(2))
        like = two[:30] + ["other"] + two[31:]
        rows += [(10 * k + 1, " ".join(one)), (10 * k + 1, " ".join(two)), (10 * k + 2, " ".join(like))]
        if k % 4 == 0:  # the two texts of one id tie two others together
            rows += [(10 * k, " ".join(one))]
    extra = [(None, "null id"), (900, None), (900, rows[0][1]), (901, ""), (901, "")]
    frame = spark.createDataFrame([*rows, *extra], "doc_id long, text string")
    got = near_duplicates(frame, width=3, percent=80).collect()
    assert len(got) == len(rows) + len(extra)
    wanted = components_by_hand([*rows, (900, rows[0][1])], 3, 80) | {901: 901, None: None}
    for r in got:
        assert r["component_id"] == wanted[r["doc_id"]], r
        assert r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"])


def test_the_encoder_drops_old_pieces(monkeypatch):
    monkeypatch.setattr(TextEncoder, "HELD", 60)
    encoder = TextEncoder(vocabulary_path())
    draw = random.Random(2)
    words = [f"word{i}" for i in range(400)]
    for _ in range(60):
        text = " ".join(draw.choices(words, [1 / (i + 1) for i in range(400)], k=30))
        ids, counts = encoder(pa.array([text, None, text]))
        own = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == own * 2 and counts.tolist() == [len(own), 0, len(own)]
        assert len(encoder.young.known) <= 30 + 31
        assert (np.diff(encoder.young.known.astype(object)) > 0).all()


def test_files_of_tasks_go_to_the_default_file_system(spark, monkeypatch):
    from types import SimpleNamespace

    import pytest

    from tenura.llm import frames

    assert frames.shared_uri(spark, "files").startswith("file:")
    context = spark.sparkContext
    cluster = SimpleNamespace(master="yarn", _jvm=context._jvm, _jsc=context._jsc)
    monkeypatch.setattr(frames, "new_path", lambda *_: "/work/files")
    with pytest.raises(ValueError, match="own disk"):
        frames.shared_uri(SimpleNamespace(sparkContext=cluster), "files")
