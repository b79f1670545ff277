"""Sharding, mixing, the pipeline and the SQL twins."""

import random
from collections import Counter

import pytest
from rows_for_tests import messy_rows
from oracle import compare, connect

import corpus_pipeline
from tillsight.llm import mixing, sharding
from tillsight.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


def test_shards_are_even_and_gapless(spark):
    out = QUERIES["op3_sharding"](spark, "/root/testdata/sf0.01").collect()
    size, slots, homes = Counter(), {}, {}
    for r in out:
        size[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
        homes.setdefault(r.text_crc32, set()).add(r.shard)
    assert sorted(size) == list(range(8)) and len(out) == 1000
    assert max(size.values()) - min(size.values()) <= 2 * max(r.size for r in out)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in homes.values())


def test_a_hot_text_is_cut(spark):
    rows = [(i, "the same text" if i % 3 == 0 else f"text {i}" * (i % 7)) for i in range(3000)]
    out = sharding.shards(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    size = Counter()
    for r in out:
        size[r.shard] += len(r.text) + 1
    assert len(out) == 3000 and max(size.values()) < 1.02 * min(size.values())


def test_more_ranges_give_the_same_shards(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    few = {(r.doc_id, r.shard, r.slot) for r in sharding.shards(docs, 8, keep=["doc_id"]).collect()}
    monkeypatch.setattr(sharding, "RANGES", 8)
    assert few == {(r.doc_id, r.shard, r.slot) for r in sharding.shards(docs, 8, keep=["doc_id"]).collect()}
    monkeypatch.setattr(sharding, "RANGE_BYTES", 500)
    keys = docs.selectExpr("xxhash64(text) h", "xxhash64(string(doc_id)) t", "octet_length(text) + 1 size")
    assert len(sharding._boundaries(keys, keys.selectExpr("sum(size)").first()[0])) > 500
    assert few == {(r.doc_id, r.shard, r.slot) for r in sharding.shards(docs, 8, keep=["doc_id"]).collect()}


def test_shards_of_messy_and_empty(messy, empty):
    out = sharding.shards(messy, 3)
    assert sorted(out.columns) == sorted(messy.columns) and out.count() == messy.count()
    assert Counter(r.doc_id for r in out.collect()) == Counter(r[0] for r in messy_rows())
    assert sharding.shards(empty, 3).count() == 0


def check_mix(rows, n, weights=None):
    """Slots are gapless, every row occurs, and every prefix keeps to the weights."""
    rows = sorted(rows, key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(len(rows)))
    assert len({(r.doc_id, r.source) for r in rows if r.epoch == 0}) == n
    if weights:
        done = Counter()
        for t, r in enumerate(rows, 1):
            done[r.source] += 1
            assert all(abs(done[s] - w * t) < 1 for s, w in weights.items())


def test_mix_keeps_to_its_weights(spark):
    rows = [(i, "abc"[min(2, i % 5)]) for i in range(1000)]
    weights = spark.createDataFrame([("a", 5.0), ("b", 3.0), ("c", 2.0)], "source string, weight double")
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), weights).collect()
    check_mix(out, 1000, {"a": 0.5, "b": 0.3, "c": 0.2})
    assert len(out) > 1000 and {r.epoch for r in out if r.source == "c"} == {0}


def test_default_mix(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    check_mix(mixing.mix(docs).collect(), docs.count())


def shares(spark, ms):
    return spark.createDataFrame([(f"s{i:04}", m) for i, m in enumerate(ms)], "g string, m long")


@pytest.mark.parametrize("ms", [[7, 11, 1, 21], [1], [1, 1], [999, 1], [333, 333, 334], [45000, 45000] + [100] * 100,
                                [2 ** 40 + 7, 2 ** 39 + 1, 3 ** 23, 5 ** 15, 2 ** 38 + 9, 7 ** 12, 2 ** 37 - 1]])
def test_schedule_meets_releases_and_deadlines(spark, ms):
    of, slots = sum(ms), 5000
    plan = sorted(mixing.schedule(shares(spark, ms), slots).collect(), key=lambda r: r.slot)
    assert [r.slot for r in plan] == list(range(slots))
    done = Counter()
    for r in plan:
        m = ms[int(r.g[1:])]
        assert r.e == done[r.g] and r.e * of // m <= r.slot < -(-(r.e + 1) * of // m)
        done[r.g] += 1


def test_schedule_of_many_random_weights(spark):
    rng = random.Random(5)
    for n in (2, 3, 10, 40, 150):
        ms = [int(rng.paretovariate(0.7) * 1000) + 1 for _ in range(n)]
        ms = [max(m, sum(ms) // 4000 + 1) for m in ms]
        of = sum(ms)
        plan = mixing.schedule(shares(spark, ms), 20_000).collect()
        assert len(plan) >= 20_000 and len({r.slot for r in plan}) == 20_000
        assert all(r.e * of // ms[int(r.g[1:])] <= r.slot < -(-(r.e + 1) * of // ms[int(r.g[1:])]) for r in plan)


def furthest(rows, weights):
    """The most that a source is ever away from its weight; checked where its count changes."""
    total, done, most = sum(weights.values()), Counter(), 0.0
    for t, r in enumerate(sorted(rows, key=lambda r: r.slot)):
        w = weights[r.source] / total
        most = max(most, abs(done[r.source] - w * t), abs(done[r.source] + 1 - w * (t + 1)))
        done[r.source] += 1
    return max([most] + [abs(done[s] - w / total * len(rows)) for s, w in weights.items()])


def test_a_long_tail_of_sources_keeps_to_its_weights(spark):
    rows = [(i, f"s{i % 2}" if i < 2500 else f"t{i}") for i in range(3000)]
    n = Counter(s for _, s in rows)
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string")).collect()
    check_mix(out, 3000)
    weights = {s: c ** 0.9 for s, c in n.items()}
    assert furthest(out, weights) < 1 + 1e-9  # these weights are rounded
    # No source is repeated more than its weight asks for.
    assert len(out) <= 1250 / (weights["s0"] / sum(weights.values())) + 1


def test_very_light_sources_are_not_lifted(spark):
    rows = [(i, "big" if i > 1 else "tiny") for i in range(100_000)]
    weights = {"big": 99_999.0, "tiny": 1.0}
    given = spark.createDataFrame(list(weights.items()), "source string, weight double")
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), given).collect()
    check_mix(out, 100_000)
    assert furthest(out, weights) < 2 and 2 <= sum(r.source == "tiny" for r in out) <= 7


def test_tiers_of_sources(spark):
    rows = [(i, f"b{i % 2}") for i in range(100_000)] + [(i, f"t{i}") for i in range(100_000, 100_300)]
    weights = {s: (30_000.0 if s[0] == "b" else 0.7) for _, s in rows}
    given = spark.createDataFrame(list(weights.items()), "source string, weight double")
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), given).collect()
    check_mix(out, 100_300)
    assert furthest(out, weights) < 2


def test_a_source_without_weight_is_spread_once(spark):
    rows = [(i, "abc"[i % 3]) for i in range(900)]
    given = spark.createDataFrame([("a", 2.0), ("b", 1.0), ("c", -1.0)], "source string, weight double")
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), given).collect()
    check_mix(out, 900)
    assert Counter(r.source for r in out) == {"a": 600, "b": 300, "c": 300}


def test_mix_of_messy_and_empty(messy, empty):
    out = mixing.mix(messy)
    assert sorted(out.columns) == sorted(messy.columns)
    once = Counter(r.doc_id for r in out.filter("epoch = 0").collect())
    assert once == Counter(r[0] for r in messy_rows())
    assert mixing.mixed_rows(messy).columns == messy.columns
    assert mixing.mix(empty).count() == 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), connect(FOLDER), SQL[name]) is None


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    counts, columns = [docs.count()], docs.columns
    for _, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).collect(), stage(spark, docs, FOLDER).schema)
        assert {r.doc_id for r in docs.select("doc_id").collect()} <= before
        counts.append(docs.count())
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert docs.columns == columns
    assert counts[0] > counts[1] > counts[2] >= counts[3] and counts[4] == counts[5]


def test_pipeline_of_messy_and_empty(spark, messy, empty, tmp_path):
    for name, docs in (("messy", messy), ("none", empty)):
        folder = str(tmp_path / name)
        docs.write.parquet(f"{folder}/documents.parquet")
        for table in ("labels", "benchmark"):
            spark.read.parquet(f"{FOLDER}/{table}.parquet").write.parquet(f"{folder}/{table}.parquet")
        out = corpus_pipeline.run(spark, folder)
        assert {"shard", "slot"} <= set(out.columns)
        assert (out.count() > 0) == (name == "messy")
