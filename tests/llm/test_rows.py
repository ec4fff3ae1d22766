"""Mixing and sharding: brute force, laws and odd rows."""

import hashlib
import math
import zlib
from collections import Counter

import duckdb
import pytest

from tenura.llm import mixing
from tenura.llm.mixing import mix, target_rates
from tenura.llm.sharding import shard_cuts, shard_documents


def poisson(doc_id, rate, seed=17):
    draws = max(math.ceil(rate / 16), 1)
    mean, total = rate / draws, 0
    for j in range(1, draws + 1):
        name = ":".join([str(seed), str(j)] + ([] if doc_id is None else [str(doc_id)]))
        u = int(hashlib.md5(name.encode()).hexdigest()[:13], 16) / 2**52
        p = c = math.exp(-mean)
        k = 0
        while c <= u and k < 100:
            k += 1
            p *= mean / k
            c += p
            total += 1
    return total


def documents(spark, n=3000):
    rows = [(i, f"t{i}", "en", "hot" if i % 3 else f"s{i % 20}", i) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_counts_are_the_inverted_distribution(spark):
    df = documents(spark)
    rates = {r["source"]: r["rate"] for r in target_rates(df).collect()}
    got = Counter(r["doc_id"] for r in mix(df).collect())
    sources = {r["doc_id"]: r["source"] for r in df.collect()}
    assert all(got[i] == poisson(i, rates[s]) for i, s in sources.items())
    weights = Counter(sources.values())
    share = {s: math.sqrt(n) for s, n in weights.items()}
    for s, n in weights.items():
        assert rates[s] * n == pytest.approx(3000 * share[s] / sum(share.values()))


def test_large_rates_and_given_weights(spark):
    df = documents(spark, 600)
    weights = spark.createDataFrame([("s0", 9.0), ("hot", 1.0), ("s3", -1.0)], "source string, weight double")
    rates = {r["source"]: r["rate"] for r in target_rates(df, weights=weights, epochs=4.0).collect()}
    assert rates["s0"] > 16 and rates["s3"] == 0 and rates["s6"] == 0
    got = Counter(r["doc_id"] for r in mix(df, weights, epochs=4.0).collect())
    for r in df.collect():
        assert got[r["doc_id"]] == poisson(r["doc_id"], rates[r["source"]])
    assert sum(got.values()) == pytest.approx(2400, rel=0.1)


def test_sql_agrees(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    wanted = con.execute(mixing.MIX_SQL).fetchall()
    assert Counter(map(tuple, mix(df).collect())) == Counter(wanted)


def test_mix_is_in_the_order_of_its_key_and_keeps_odd_rows(spark):
    rows = [(1, None, None), (None, "", "a"), (2, "x", "a"), (2, "x", "a"), (3, "y", None)] * 30
    df = spark.createDataFrame([(*r, "old") for r in rows], "doc_id long, text string, source string, copy string")
    out = mix(df)
    keys = [r["shuffle_key"] for r in out.collect()]
    assert keys == sorted(keys) and out.columns == ["doc_id", "text", "source", "copy", "shuffle_key"]
    got = Counter(r["doc_id"] for r in out.collect())
    rates = {r["source"]: r["rate"] for r in target_rates(df).collect()}
    assert got[2] == 60 * poisson(2, rates["a"]) and got[None] == 30 * poisson(None, rates["a"])
    assert mix(df, marked=False).columns == df.columns
    assert mix(df.limit(0)).count() == 0


def groups_of(rows):
    out = {}
    for doc_id, text in rows:
        data = None if text is None else text.encode()
        key = hashlib.md5(data).hexdigest() if data is not None else "n" + hashlib.md5(
            ("id" if doc_id is None else f"id:{doc_id}").encode()).hexdigest()
        out[key] = out.get(key, 0) + len(data or b"") + 8
    return [(k, out[k]) for k in sorted(out)]


def smallest_capacity(sizes, shards):
    def fits(capacity):
        used, held = 1, 0
        for s in sizes:
            if s > capacity:
                return False
            if held + s > capacity:
                used, held = used + 1, 0
            held += s
        return used <= shards

    low, high = 0, sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


@pytest.mark.parametrize("shards", [1, 3, 24])
@pytest.mark.parametrize("hot", [0, 400])
def test_shards_are_minimax(spark, shards, hot):
    rows = [(i, "ab é" * (i * 7919 % 90)) for i in range(900)] + [(5000 + i, "same " * 30) for i in range(hot)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = shard_documents(df, shards).collect()
    groups = groups_of(rows)
    held = Counter()
    for r in got:
        held[r["shard"]] += r["size"]
    assert max(held.values()) == smallest_capacity([s for _, s in groups], shards)
    assert max(held) < shards and sum(held.values()) == sum(s for _, s in groups)
    if not hot:
        largest = max(s for _, s in groups)
        assert len(held) == shards and min(held.values()) >= max(held.values()) - 2 * largest
    texts = dict(rows)
    of_text = {}
    slots = {}
    for r in got:
        data = texts[r["doc_id"]].encode()
        assert r["size"] == len(data) + 8 and r["text_crc32"] == zlib.crc32(data)
        assert of_text.setdefault(data, r["shard"]) == r["shard"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_cuts_need_only_few_prefixes(spark, monkeypatch):
    from tenura.llm import sharding

    monkeypatch.setattr(sharding, "_FIRST", 1)
    rows = [(hashlib.md5(str(i).encode()).hexdigest(), 1 + i % 50) for i in range(5000)]
    groups = spark.createDataFrame(rows, "key string, bytes long").cache()
    capacity, begins = shard_cuts(groups, 7)
    assert capacity == smallest_capacity([s for _, s in sorted(rows)], 7) and len(begins) == 6


def test_odd_rows(spark):
    rows = [(1, None), (2, None), (3, ""), (4, "a"), (4, "a"), (None, "a"), (None, None)]
    df = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, shard int")
    got = [r.asDict() for r in shard_documents(df, 24).collect()]
    assert len(got) == 7 and {r["law"] for r in got} == {"bytes"}
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in got} == {
        (1, 8, 0), (2, 8, 0), (3, 8, 0), (4, 9, zlib.crc32(b"a")), (None, 9, zlib.crc32(b"a")), (None, 8, 0),
    }
    assert len({r["shard"] for r in got if r["size"] == 9}) == 1
    assert shard_documents(df.limit(0), 24).count() == 0
