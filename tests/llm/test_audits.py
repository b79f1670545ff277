"""Source divergence and filter interaction: SQL twins on messy rows, matrix and refinement against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow.compute as pc
import pytest
from oracle import compare, connect
from rows_for_tests import messy_rows
from pyspark.sql import functions as F

from tillsight.llm import divergence, filter_audit, term_matrix
from tillsight.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
AUDITS = ("op12_divergence", "op13_filter_audit")


def _folder(spark, docs, labels, path):
    docs.write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    con = connect(FOLDER)
    for name in ("documents", "labels"):
        con.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{path}/{name}.parquet/*.parquet'")
    return con


@pytest.mark.parametrize("name", AUDITS)
def test_messy_rows_match_sql(spark, messy, tmp_path, name):
    labels = spark.createDataFrame(
        [(i, i % 2 if i % 5 else None, int(i % 3 == 0)) for i in range(20)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)],
        "doc_id long, quality long, toxic long")
    con = _folder(spark, messy, labels, tmp_path)
    assert compare(QUERIES[name](spark, str(tmp_path)), con, SQL[name]) is None


@pytest.mark.parametrize("name", AUDITS)
def test_empty_table(spark, empty, tmp_path, name):
    _folder(spark, empty, spark.read.parquet(f"{FOLDER}/labels.parquet"), tmp_path)
    assert QUERIES[name](spark, str(tmp_path)).count() == 0


def _plain_terms(rows, least):
    seen = defaultdict(Counter)
    for _, text, lang, *_ in rows:
        seen[lang or ""].update(set(re.findall(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").encode().lower())))
    return {(lang, t) for lang, c in seen.items() for t, n in c.items() if n >= least}


@pytest.mark.parametrize("least", [1, 2, 3])
def test_refinement_keeps_the_frequent_terms(spark, least):
    rng = random.Random(least)
    stem = "".join(rng.choice("abc") for _ in range(200))
    texts = [" ".join(stem[:rng.choice([1, 3, 4, 5, 8, 9, 15, 16, 17, 64, 130])] + rng.choice(["", "x", "é", "Y"]) for _ in range(9))
             for _ in range(60)]
    rows = [(i, t, rng.choice(["en", "de"]), "s", 0) for i, t in enumerate(texts)] + messy_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    kept = divergence.kept_terms(divergence._counted(docs), least).collect()
    assert len(kept) == len({(r.lang, bytes(r.item)) for r in kept})
    assert {(r.lang, bytes(r.item)) for r in kept} == _plain_terms(rows, least)


def test_levels_end_at_the_terms_length():
    for size in range(1, 200):
        level = divergence._level(size)
        assert size <= divergence.FIRST << level and (level == 0 or size > divergence.FIRST << (level - 1))


def test_share_is_exact_for_large_counts():
    rng = random.Random(1)
    total = np.array([rng.randint(1, 9 * 10**15) for _ in range(5000)])
    count = np.array([rng.randint(0, int(t) + 1) for t in total])
    assert divergence.share(count, total).tolist() == [10**9 * int(c) // int(t) for c, t in zip(count, total)]


def test_blocks_add_up(spark, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    whole = sorted(divergence.audit(docs).collect())
    monkeypatch.setattr(divergence, "BLOCK", 200)
    assert sorted(divergence.audit(docs).collect()) == whole


def test_matrix_holds_every_word(spark, messy):
    docs = messy.select("doc_id", "text").filter("doc_id <> 9").repartition(4)
    named = lambda batch, texts: pc.make_struct(batch.column(0), field_names=["doc_id"])
    cut = term_matrix.shards(docs, named, "doc_id: long")
    numbers, words = term_matrix.dictionary(cut)
    names = {r.word_id: bytes(r.word) for r in words.collect()}
    assert sorted(names) == list(range(len(names))) and len(set(names.values())) == len(names)
    found = {}
    csr = term_matrix.matrix(cut, numbers)
    for r in csr.collect():
        columns, counts = np.frombuffer(r.columns, np.int64), np.frombuffer(r.counts, np.int32)
        for i, row in enumerate(r.rows):
            own = slice(r.indptr[i], r.indptr[i + 1])
            assert len(set(columns[own])) == len(columns[own])
            found.setdefault(row.doc_id, []).append({names[c]: n for c, n in zip(columns[own], counts[own])})
    for doc_id, text in {(r[0], r[1]) for r in messy_rows() if r[0] not in (9, None)}:
        assert found[doc_id] == [dict(Counter((text or "").encode().split()))]
    figures = term_matrix.row_figures(csr).filter("doc_id = 13").first()
    text = next(r[1] for r in messy_rows() if r[0] == 13).encode().split()
    assert (figures.n_words, figures.n_distinct) == (len(text), len(set(text)))


def test_shards_hand_on_their_new_words():
    words = term_matrix._List()
    words.add(b"a b a")
    words.add(b"")
    first = [x.to_pylist()[0] for x in words.shard()]
    words.add(b"c b d")
    second = [x.to_pylist()[0] for x in words.shard()]
    entries = lambda x: np.frombuffer(x, np.int32).tolist()
    assert first[:3] == [0, [b"a", b"b"], [0, 2, 2]] and (entries(first[3]), entries(first[4])) == ([0, 1], [2, 1])
    assert second[:3] == [2, [b"c", b"d"], [0, 3]] and entries(second[3]) == [2, 1, 3]


def test_copies_across_sources(spark):
    """A hot text: all but the smallest id fail E, whatever was removed, and rows without id never do."""
    text = "some plain words " * 100
    rows = [(i, text, "ab"[i % 2]) for i in range(500)] + [(None, text, "a"), (0, text, "a"), (1000, "other", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(10)], "doc_id long, quality long, toxic long")
    sets = {(r.part, r.mask): (r.n, r.good) for r in filter_audit.failure_sets(docs, labels).filter("n > 0").collect()}
    assert sets == {("a", 2): (3, 2), ("a", 18): (249, 4), ("b", 18): (250, 5), ("", 1): (1, 0)}
    steps = filter_audit.audit(docs, labels).filter("part = 'a' AND filter = 'E'").select(
        "filter_order", "removed", "redundant", "shapley").collect()
    assert len(steps) == 120 and {r.shapley for r in steps} == {249 * 60}
    assert all((r.removed, r.redundant) == ((0, 249) if r.filter_order.index("B") < r.filter_order.index("E") else (249, 0))
               for r in steps)


def test_every_part_has_all_orders_and_steps(spark):
    out = filter_audit.audit(spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet"))
    sizes = out.groupBy("part").agg(F.count("*").alias("n"), F.countDistinct("filter_order", "step").alias("m")).collect()
    assert {(r.n, r.m) for r in sizes} == {(600, 600)}
