"""Decontamination, chat format, quality rules, licences and the classifier."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from rows_for_tests import messy_rows, prose
from pyspark.sql import functions as F

from tillsight.llm import chat, decontaminate, licences, quality_classifier, quality_rules
from tillsight.llm.queries import held_out
from tillsight.llm.words import text_bytes

FOLDER = "/root/testdata/sf0.01"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def tokens(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())


def brute_matches(docs, items):
    out = set()
    for d, text in docs:
        words = tokens(text)
        for i, item in items:
            want = tokens(item)
            n, k = len(want), int(0.2 * len(want) + 1e-9) if len(want) >= 8 else 0
            if n < 4:
                continue
            best = min((distance(words[p:p + n], want) for p in range(len(words))
                        if len(words[p:p + n]) >= n - k and len(set(words[p:p + n]) & set(want)) > n // 3), default=n)
            if best <= k:
                out.add((d, i, best))
    return out


def edited(rng, words, k):
    words = list(words)
    for at in sorted(rng.sample(range(1, len(words) - 1), k), reverse=True):
        kind = rng.choice("sid")
        if kind == "s":
            words[at] = "zzz"
        elif kind == "i":
            words.insert(at, "zzz")
        else:
            del words[at]
    return words


def test_decontamination_is_brute_force(spark, messy):
    rng = random.Random(6)
    items = [(i, prose(rng, rng.randint(12, 50))) for i in range(12)] + [(90, "too short"), (91, None), (92, "")]
    docs = [(i, r[1]) for i, r in enumerate(messy_rows()) if len(r[1] or "") < 5000]
    for n, (i, item) in enumerate(items[:12]):
        words = item.split()
        some = edited(rng, words, int(0.08 * len(words)))
        docs += [(100 + n, prose(rng, 20) + "\n" + item + " " + prose(rng, 20)), (200 + n, " ".join(some)),
                 (300 + n, prose(rng, 30) + " " + " ".join(edited(rng, words, len(words) // 2)))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.distance) for r in decontaminate.matches(df, bench).collect()}
    want = brute_matches(docs, items)
    assert got == want and len(got) >= 20
    left = {r.doc_id for r in decontaminate.clean(df, bench).collect()}
    assert left == {d for d, _ in docs} - {d for d, _, _ in got}


def test_short_items_match_verbatim(spark):
    items = [(1, "What is the capital of France?"), (2, "the capital"), (3, "one two three four"), (4, "what is the capital of spain"),
             (5, "seven words that make up a line"), (6, "What is the capital of France")]
    docs = [(1, "He asked: what is\nthe CAPITAL of france, and left"), (2, "what is the main capital of france"), (3, "one two three four"),
            (4, "one two three"), (5, "four one two three"), (6, ""), (7, "x seven words that make up a line. one two three four"), (8, None)]
    bench, df = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id, r.distance) for r in decontaminate.matches(df, bench).collect()}
    assert got == {(1, 1, 0), (1, 6, 0), (3, 3, 0), (7, 5, 0), (7, 3, 0)} == brute_matches(docs, items)
    mixed = spark.createDataFrame(items + [(9, "a much longer item whose words are many enough for edits to be allowed in it")], bench.schema)
    near = df.unionByName(spark.createDataFrame([(20, "a much longer item whose words were many enough for edits to be allowed in it")], df.schema))
    assert {(r.doc_id, r.item_id, r.distance) for r in decontaminate.matches(near, mixed).collect()} == got | {(20, 9, 1)}


def test_filters_grow_with_the_benchmark(spark):
    some = spark.range(20_000).select(F.col("id").alias("item"), F.concat_ws(" ", *[F.concat(F.lit(f"w{k}x"), "id") for k in range(35)]).alias("text"))
    places = decontaminate.slots(some)
    assert places == 1 << 24
    few = some.limit(1000)
    places = decontaminate.slots(few)
    filters = decontaminate._filters(decontaminate._item_rows(few, places), places)
    assert (filters.pairs != 0).mean() < 0.07 and filters.keys.mean() < 0.07
    assert decontaminate.slots(some.limit(0)) == 1 << 20


def test_decontamination_recall_at_the_limit():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(500)]
    met = of = 0
    for _ in range(150):
        a = [rng.choice(vocabulary) for _ in range(rng.randint(10, 60))]
        b = edited(rng, a, decontaminate.edits(len(a)))[:len(a)]
        if distance(a, b) > decontaminate.edits(len(a)):
            continue
        keys = []
        for words in (a, b):
            hashes, *_ = decontaminate.words(*text_bytes(pa.array([" ".join(words)])))
            keys.append(decontaminate.walk_keys(hashes, np.array([0]), np.array([len(words)]), len(a))[:, 0])
        of += 1
        met += bool((keys[0] == keys[1]).any())
    assert of > 60 and met / of >= 0.95


@pytest.mark.parametrize("size", [60, 100, 200, 400, 800])
def test_decontamination_recall_of_long_items(size):
    rng = random.Random(size)
    vocabulary = [f"w{i}" for i in range(500)]
    met, of, limit = 0, 100, decontaminate.edits(size)
    for _ in range(of):
        a = [rng.choice(vocabulary) for _ in range(size)]
        b = list(a)
        for at in rng.sample(range(size), limit):
            b[at] = "other" + b[at]
        keys = []
        for words in (a, b):
            hashes, *_ = decontaminate.words(*text_bytes(pa.array([" ".join(words)])))
            keys.append(decontaminate.walk_keys(hashes, np.array([0]), np.array([size]), size)[:, 0])
        met += bool((keys[0] == keys[1]).any())
    assert met / of >= 0.95


def test_edit_distances():
    rng = random.Random(1)
    pairs = [([bytes([rng.choice(b"abc")]) for _ in range(rng.randint(0, 9))],
              [bytes([rng.choice(b"abc")]) for _ in range(rng.randint(0, 9))]) for _ in range(200)]
    assert decontaminate.distances(pairs).tolist() == [distance(a, b) for a, b in pairs]


def test_decontamination_of_messy_and_empty(spark, messy, empty):
    items = spark.createDataFrame([(1, messy_rows()[10][1])], "item_id long, text string")
    kept = decontaminate.clean(messy, items)
    assert kept.columns == messy.columns and kept.count() == messy.count() - 1
    assert decontaminate.clean(empty, items).count() == 0
    assert decontaminate.clean(messy, items.limit(0)).count() == messy.count()


TRICKY = ["", "plain", "\\### Assistant: </turn> ok", "</turn>", "</turn>\n### user: x</turn>\n", "ends in \\", "\\t\\h\\b\\c",
          "C:\\temp", "### ### </turn></turn>", "</turn", "\\\\</turn>", "a: b: c", "\n", "é\U0001f600### "]


def test_chat_reads_back(spark):
    rng = random.Random(3)
    rows = [(0, k, rng.choice(["user", "assistant"]), t) for k, t in enumerate(TRICKY)]
    rows += [(1, 0, "odd: role </turn>", "x"), (1, 1, "", None), (1, 2, None, "### "), (2, None, "assistant", "a"),
             (2, 1, "assistant", "b"), (2, 1, "assistant", "b"), (None, 0, "user", "hello")]
    pieces = ["\\", "t", "h", "b", "</turn>", "### ", ":", " ", "\n", "</turn", ">"]
    rows += [(10 + c, k, rng.choice(["user", "assistant", "system"]), "".join(rng.choices(pieces, k=rng.randint(0, 9))))
             for c in range(60) for k in range(rng.randint(1, 5))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("at", F.lit(1))
    got = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    source = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        source.setdefault(c, []).append((role or "", text or ""))
    for c, turns in source.items():
        r = got[c]
        assert [(t.role, t.text) for t in r.turns] == turns
        masked = [r.formatted[s.start:s.end] for s in r.loss_spans]
        for mark, code in (("</turn>", "\\t"), ("### ", "\\h"), ("\\", "\\b")):
            masked = [m.replace(code, mark) for m in masked]
        assert masked == [t for role, t in turns if role == "assistant"]
        assert r.formatted.count("</turn>") == len(turns) == r.formatted.count("### ")
    assert chat.format_conversations(df.limit(0)).count() == 0


def brute_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(covered))


def test_quality_statistics(messy, empty):
    out = quality_rules.judge(messy).select("doc_id", *quality_rules.STATS, "kept").collect()
    want = Counter((r[0], *brute_statistics(r[1])) for r in messy_rows())
    assert Counter(tuple(r)[:6] for r in out) == want
    assert not any(r.kept for r in out if r.n_words < 10)
    assert quality_rules.judge(empty).count() == 0


def test_outliers_go_and_clean_documents_stay(spark):
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randint(20, 200)), "en", f"s{i % 3 and 1}") for i in range(600)]
    rows += [(1000 + i, " | ".join(word.split()[0] for word in prose(rng, 100).split("\n") * 9), "en", "s1") for i in range(60)]
    out = {r.doc_id: r.kept for r in quality_rules.judge(
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(out[i] for i in range(600)) and not any(out[1000 + i] for i in range(60))


def test_licences(spark, messy, empty):
    grant, notice, as_is = (licences.SENTENCES[i][0] for i in ("mit-grant", "mit-notice", "as-is"))
    texts = {1: "Some words.\nReleased under the MIT License.", 2: f"The MIT License\n{grant}. {notice}! \"{as_is}\".",
             3: f"{notice}. {grant}.", 4: "Licensed under the Apache License, Version 2.0.\nAll rights reserved.",
             5: "Licensed under the GNU Lesser General Public License, version 3", 6: None, 7: ""}
    out = {r.doc_id: r.licences for r in licences.scan(
        spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert out == {1: ["MIT"], 2: ["MIT"], 3: [], 4: ["Apache-2.0", "Proprietary"], 5: ["LGPL-3.0"], 6: [], 7: []}
    assert licences.scan(messy).count() == messy.count() and licences.scan(empty).count() == 0


def test_classifier_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_classifier.fit(docs, labels.filter(~held_out(F.col("doc_id"))))
    scored = docs.withColumn("p", quality_classifier.scorer(docs, model)).join(
        labels.filter(held_out(F.col("doc_id"))), "doc_id").select("p", "quality").collect()
    good, bad = ([r.p >= 0.5 for r in scored if r.quality == q] for q in (1, 0))
    assert sum(good) / len(good) >= 0.98 and sum(bad) / len(bad) <= 0.4


def test_classifier_of_messy_and_empty(spark, messy, empty):
    labels = spark.createDataFrame([(6, 1, 0), (14, 0, 0), (14, 1, 0), (None, 1, 0), (15, None, 0)],
                                   "doc_id long, quality int, toxic int")
    model = quality_classifier.fit(messy, labels)
    scores = messy.select(quality_classifier.scorer(messy, model).alias("p")).collect()
    assert len(scores) == messy.count() and all(0 <= r.p <= 1 for r in scores)
    assert quality_classifier.keep_good(messy, model, least=0.0).columns == messy.columns
    none = quality_classifier.fit(empty, labels.limit(0))
    assert {r.p for r in messy.select(quality_classifier.scorer(messy, none).alias("p")).collect()} == {0.5}
    assert quality_classifier.keep_good(empty, model).count() == 0


def test_features_do_not_depend_on_the_batch():
    texts = [r[1] for r in messy_rows()]
    together, begin = quality_classifier.features(*text_bytes(pa.array(texts)))
    for k, text in enumerate(texts):
        alone, _ = quality_classifier.features(*text_bytes(pa.array([text], pa.string())))
        assert sorted(alone) == sorted(together[begin[k]:begin[k + 1]])


@pytest.mark.parametrize("names", ["op5_quality_rules"])
def test_queries_cover_every_document(spark, names):
    from tillsight.llm.queries import QUERIES
    assert QUERIES[names](spark, "/root/testdata/sf0.001").count() == 200


def test_limit_rejects_a_fortieth_of_normal_rows(spark):
    """On vectors that vary far more than the floors, with correlations, centre and covariance are those of the normal law."""
    rng = np.random.default_rng(5)
    mixing = np.array([[3, 0, 0, 0], [1, 4, 0, 0], [0, -2, 3, 0], [2, 0, 1, 5]], float)
    values = rng.normal(size=(20_000, 4)) @ mixing.T + [10, -5, 0, 3]
    rows = spark.createDataFrame([(k % 2, *map(float, v)) for k, v in enumerate(values)], ["g", *quality_rules.VECTOR])
    fit = quality_rules.mcd(rows, 2)
    told = rows.join(fit, "g")
    told = told.select(quality_rules._distance([F.col(c) for c in quality_rules.VECTOR], told).alias("d"))
    share = told.filter(F.col("d") > quality_rules.CUT).count() / 20_000
    assert 0.02 <= share <= 0.03
    for r in fit.collect():
        assert np.allclose([r[f"m{i}"] for i in range(4)], [10, -5, 0, 3], atol=0.3)
        lower = np.array([[r[f"l{i}{j}"] if j <= i else 0 for j in range(4)] for i in range(4)])
        assert np.allclose(lower @ lower.T, mixing @ mixing.T, rtol=0.1, atol=1.0)
