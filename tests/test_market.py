"""Baskets, recommendations, attribution, tests of independence and journeys on small cases with known answers."""

import datetime as dt
import itertools
import math
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from tillsight import session
from tillsight.operators import attribution, baskets, extras, hypothesis, recommend


def d(text):
    return dt.date.fromisoformat(text)


def _by_hand(rows, support):
    """Itemsets by counting every subset."""
    counts = Counter(s for r in rows for n in range(1, len(set(r)) + 1) for s in itertools.combinations(sorted(set(r)), n))
    return {s: n for s, n in counts.items() if n >= math.ceil(support * len(rows))}


@pytest.mark.parametrize("support", [0.02, 0.1, 0.5])
def test_itemsets_and_rules_against_all_subsets(spark, support):
    rng = random.Random(2)
    rows = [sorted({rng.choice("aaabbcdefg") for _ in range(rng.randint(1, 6))}) for _ in range(200)]
    found = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "order_id long, items array<string>")
    sets = baskets.frequent_itemsets(found, support)
    expected = _by_hand(rows, support)
    assert {tuple(r["items"]): r["orders"] for r in sets.collect()} == expected
    rules = baskets.association_rules(sets, 0.3).collect()
    made = {(tuple(r.antecedent), r.consequent): r for r in rules}
    want = {(tuple(x for x in s if x != c), c): n for s, n in expected.items() if len(s) > 1 for c in s}
    assert set(made) == {(a, c) for (a, c), n in want.items() if n / expected[a] >= 0.3}
    for (a, c), r in made.items():
        n, confidence, alone = want[a, c], want[a, c] / expected[a], expected[c,] / 200
        assert (r.support, r.confidence, r.lift) == pytest.approx((n / 200, confidence, confidence / alone))
        assert r.leverage == pytest.approx(n / 200 - expected[a] / 200 * alone)
        assert r.conviction == (None if confidence == 1 else pytest.approx((1 - alone) / (1 - confidence)))


def test_baskets_leave_unsold_orders_and_copies_out(spark):
    orders = spark.createDataFrame([(1, "Completed"), (2, "Cancelled"), (3, "Delivered")], "order_id long, order_status string")
    items = spark.createDataFrame([(1, 7), (1, 5), (1, 7), (2, 5), (3, 5), (3, None)], "order_id long, product_id long")
    products = spark.createDataFrame([(5, "x"), (7, "x")], "product_id long, brand string")
    assert {r.order_id: r["items"] for r in baskets.baskets(orders, items).collect()} == {1: [5, 7], 3: [5]}
    by_brand = baskets.baskets(orders, items, products, "brand").collect()
    assert {r.order_id: r["items"] for r in by_brand} == {1: ["x"], 3: ["x"]}


def test_suggestions_need_the_whole_antecedent(spark):
    found = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"]), (3, ["a", "b", "c"])], "order_id long, items array<string>")
    rules = spark.createDataFrame([(["a", "b"], "c", 0.9), (["a"], "d", 0.5), (["a"], "b", 0.5), (["b"], "c", 0.1)],
                                  "antecedent array<string>, consequent string, confidence double")
    out = {(r.order_id, r.place): (r["item"], r.confidence) for r in baskets.suggestions(found, rules, 2).collect()}
    assert out == {(1, 1): ("c", 0.9), (1, 2): ("d", 0.5), (2, 1): ("b", 0.5), (2, 2): ("d", 0.5), (3, 1): ("d", 0.5)}


def test_recommendations_follow_planted_tastes(spark):
    """Customers buy within one of three tastes; what they have not bought of it comes first."""
    rng = random.Random(4)
    rows = [(f"c{c}", taste * 100 + p, 1) for c in range(120) for taste in [c % 3] for p in rng.sample(range(20), 12)]
    rows += [("all", taste * 100 + p, 1) for taste in range(3) for p in range(20)]
    found = spark.createDataFrame(rows, "customer_id string, product_id long, orders long")
    made = recommend.train(found, rank=8)
    out = recommend.recommend(made, 5).collect()
    listed = {}
    for r in out:
        listed.setdefault(r.customer_id, []).append((r.place, r.product_id, r.score))
    assert set(listed) == {f"c{c}" for c in range(120)}  # who has everything gets nothing
    had = {(c, p) for c, p, _ in rows}
    hits = 0
    for customer, places in listed.items():
        places.sort()
        assert [p for p, _, _ in places] == [1, 2, 3, 4, 5]
        assert [s for *_, s in places] == sorted((s for *_, s in places), reverse=True)
        assert not any((customer, p) in had for _, p, _ in places)
        hits += sum(p // 100 == int(customer[1:]) % 3 for _, p, _ in places)
    assert hits >= 0.95 * 600


def test_purchases_count_orders_once(spark):
    orders = spark.createDataFrame([(1, 9, "Completed"), (2, 9, "Delivered"), (3, 9, "Cancelled")],
                                   "order_id long, customer_id long, order_status string")
    items = spark.createDataFrame([(1, 5), (1, 5), (2, 5), (3, 5), (2, 6)], "order_id long, product_id long")
    assert {tuple(r) for r in recommend.purchases(orders, items).collect()} == {(9, 5, 2), (9, 6, 1)}


def test_nothing_bought_gives_no_recommendation(spark):
    orders = spark.createDataFrame([(1, 9, "Cancelled")], "order_id long, customer_id long, order_status string")
    items = spark.createDataFrame([(1, 5)], "order_id long, product_id long")
    assert recommend.purchases(orders, items).count() == 0


CAMPAIGNS = "campaign_id long, segment string, start_date date, end_date date, budget double"
ORDERS = "order_id long, segment string, order_date date, total_amount double, order_status string"


@pytest.fixture(scope="module")
def shop(spark):
    campaigns = spark.createDataFrame(
        [(1, "a", d("2024-01-01"), d("2024-01-10"), 30.0), (2, "a", d("2024-01-05"), d("2024-01-05"), 10.0),
         (3, "b", d("2024-01-05"), d("2024-02-01"), 0.0), (4, "b", d("2024-01-09"), d("2024-01-02"), 10.0),
         (5, None, None, d("2024-01-02"), 10.0)], CAMPAIGNS)
    orders = spark.createDataFrame(
        [(1, "a", d("2024-01-05"), 100.0, "Completed"), (2, "b", d("2024-01-05"), 20.0, "Delivered"),
         (3, "a", d("2024-01-10"), 8.0, "Completed"), (4, "a", d("2024-01-11"), 50.0, "Completed"),
         (5, "a", d("2024-01-05"), 999.0, "Cancelled"), (6, "b", d("2024-03-01"), 7.0, "Completed")], ORDERS)
    return campaigns, orders


def _revenue(df):
    return {r.campaign_id: r.attributed_revenue for r in df.collect()}


def test_attribution_by_hand(shop):
    campaigns, orders = shop
    assert _revenue(attribution.campaign_revenue(campaigns, orders)) == {1: 40 + 4, 2: 40, 3: 40 + 4 + 50, 4: 0, 5: 0}
    assert _revenue(attribution.campaign_revenue(campaigns, orders, weight="budget")) == {1: 90 + 8, 2: 30, 3: 0, 4: 0, 5: 0}
    assert _revenue(attribution.campaign_revenue(campaigns, orders, by=["segment"])) == {1: 50 + 8, 2: 50, 3: 20, 4: 0, 5: 0}
    shares = {r.order_id: (r.campaigns, r.revenue_per_campaign) for r in attribution.order_shares(orders, campaigns).collect()}
    assert shares == {1: (3, 100 / 3), 2: (3, 20 / 3), 3: (2, 4.0), 4: (1, 50.0), 6: (0, None)}


def test_attributed_revenue_is_kept_under_skew(spark):
    """One campaign over everything beside many short ones, a third of the orders on one day: no revenue is lost."""
    rng, first = random.Random(8), d("2020-01-01")
    day = lambda n: first + dt.timedelta(n)
    campaigns = [(0, "x", first, day(4000), 1.0)]
    campaigns += [(i, "x", day(a := rng.randrange(1000)), day(a + rng.randrange(30)), 1.0) for i in range(1, 3000)]
    orders = [(i, "x", day(500 if i % 3 == 0 else rng.randrange(1200)), rng.randrange(1, 10**6) / 100, "Completed") for i in range(6000)]
    c, o = spark.createDataFrame(campaigns, CAMPAIGNS), spark.createDataFrame(orders, ORDERS)
    found = attribution.campaign_revenue(c, o)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    got = _revenue(found)
    assert math.fsum(got.values()) == pytest.approx(math.fsum(r[3] for r in orders), abs=0.01)
    earned = Counter()
    for _, _, at, amount, _ in orders:
        earned[at] += amount
    running = {at: [k for k, _, a, b, _ in campaigns if a <= at <= b] for at in earned}
    want = Counter()
    for at, amount in earned.items():
        for k in running[at]:
            want[k] += amount / len(running[at])
    assert all(got[k] == pytest.approx(want[k], abs=0.001) for k in got)


def test_chi_square_tail_against_known_values(spark):
    """Quantiles from tables, and both ends: by the closed forms for 1 and 2 degrees of freedom."""
    rows = [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (7.814727903251179, 3, 0.05),
            (18.307038053275146, 10, 0.05), (24.995790139728616, 15, 0.05), (124.34211340400407, 100, 0.05),
            (0.0, 3, 1.0), (-1.0, 3, 1.0), (1e-9, 1, math.erfc(math.sqrt(5e-10))), (900.0, 2, math.exp(-450))]
    rows += [(x, 1, math.erfc(math.sqrt(x / 2))) for x in (0.01, 0.5, 1.0, 6.0, 12.4, 12.6, 40.0, 300.0, 1400.0)]
    rows += [(x, 3, math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2)) for x in (0.3, 4.0, 90.0, 800.0)]
    out = spark.createDataFrame(rows, "x double, f int, want double").select(
        "want", hypothesis.chi_square_tail(F.col("x"), F.col("f")).alias("got")).collect()
    for r in out:
        assert r.got == pytest.approx(r.want, rel=1e-9, abs=1e-300)


def test_chi_square_by_hand(spark):
    cells = [("a", "x", 10), ("a", "y", 20), ("b", "x", 30), ("b", "y", 0), ("a", None, 5), (None, "x", 5)]
    rows = [(a, b) for a, b, n in cells for _ in range(n)]
    r = hypothesis.chi_square_test(spark.createDataFrame(rows, "a string, b string"), "a", "b").first()
    assert (r.n, r.degrees_of_freedom) == (60, 1)
    assert r.statistic == pytest.approx(30.0) and r.p_value == pytest.approx(math.erfc(math.sqrt(15)), rel=1e-9)
    assert r.cramers_v == pytest.approx(math.sqrt(0.5))
    one = hypothesis.chi_square_test(spark.createDataFrame([("a", "x")] * 3, "a string, b string"), "a", "b").first()
    assert (one.n, one.degrees_of_freedom, one.statistic, one.p_value, one.cramers_v) == (3, 0, 0.0, 1.0, None)
    none = hypothesis.chi_square_test(spark.createDataFrame([], "a string, b string"), "a", "b").first()
    assert (none.n, none.degrees_of_freedom, none.p_value) == (0, 0, 1.0)


def test_journeys_against_a_plain_walk(spark):
    rng = random.Random(5)
    rows = [(rng.choice([1, 2, 3, 4, 5, 6, None]) if i % 3 else 1, rng.choice(["view", "click", "purchase", "error"]),
             dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(600))) for i in range(60)] + [(7, "click", None)]
    steps = ("view", "click", "purchase")
    for part in (rows[:12], rows[:25], rows):
        events = spark.createDataFrame(part, "user_id long, event_type string, ts timestamp_ntz")
        done = Counter()
        for user in {u for u, _, t in part if u is not None and t is not None}:
            at = dt.datetime.min
            for step in steps:
                times = [t for u, e, t in part if u == user and e == step and t is not None and t >= at]
                if not times:
                    break
                at = min(times)
                done[step] += 1
        for bucket in ("minute", "hour", "year"):
            found = extras.journeys(events, steps, bucket)
            assert {(r.place, r.step): r.users for r in found.collect()} == {(i + 1, s): done[s] for i, s in enumerate(steps)}
    assert extras.journeys(events.limit(0)).collect()[0].users == 0
    with pytest.raises(ValueError):
        extras.journeys(events, ("view", "view"))


def test_journeys_scan_once(spark):
    from tillsight.sources.star import Star
    plan = extras.journeys(Star(spark, "/root/testdata/sf0.001").events())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_elasticity_needs_a_sample(spark):
    rows = [(1, i + 1, 100.0 / (i + 1)) for i in range(10)] + [(2, i + 1, 100.0 / (i + 1)) for i in range(9)]
    items = spark.createDataFrame(rows, "product_id long, quantity int, unit_price double")
    out = {r.product_id: (r.lines, r.elasticity) for r in extras.price_elasticity(items).collect()}
    assert out[1] == (10, pytest.approx(-1.0)) and out[2] == (9, None)


def test_blocks_hold_every_pair(spark, monkeypatch):
    # Several blocks of customers and products, and long beside short histories: the lists are those of all pairs.
    monkeypatch.setattr(recommend, "USERS", 7)
    monkeypatch.setattr(recommend, "ITEMS", 16)
    rows = [(c, p, 1 + (c + p) % 3) for c in range(30) for p in range(50) if (c * 7 + p * 3) % 11 < 4 or c == 5 and p < 47]
    made = recommend.train(spark.createDataFrame(rows, "customer_id long, product_id long, orders long"), rank=4, rounds=3)
    factors = lambda df: np.array([r.features for r in df.orderBy("id").collect()], np.float32)
    scores = factors(made.model.userFactors) @ factors(made.model.itemFactors).T
    had = {(c, p) for c, p, _ in rows}
    out = {}
    for r in recommend.recommend(made, 5).orderBy("customer_id", "place").collect():
        out.setdefault(r.customer_id, []).append(r)
    assert 0 < len(out[5]) < 5  # nearly everything bought
    for c in range(30):
        left = sorted((scores[c, p] for p in range(50) if (c, p) not in had), reverse=True)
        assert [r.place for r in out[c]] == [*range(1, min(5, len(left)) + 1)]
        assert np.allclose([r.score for r in out[c]], left[:5], atol=1e-5)
        assert not any((c, r.product_id) in had for r in out[c])


def test_factors_are_those_of_sparks_als(spark, monkeypatch):
    # Many blocks, a product that all bought and one order among many: Spark's own fit gives the same factors.
    monkeypatch.setattr(recommend, "PURCHASES", 150)
    monkeypatch.setattr(recommend, "SOME", 16)
    rows = [(c, p, 1 + (c + p) % 3) for c in range(70) for p in range(50) if (c * 7 + p * 3) % 11 < 4 or p == 9]
    found = spark.createDataFrame(rows, "customer_id long, product_id long, orders long")
    made = recommend.train(found, rank=4, rounds=3)
    own = ALS(userCol="customer_id", itemCol="product_id", ratingCol="orders", implicitPrefs=True, rank=4, maxIter=3, regParam=0.05,
              alpha=20.0, seed=42, numUserBlocks=8, numItemBlocks=8).fit(found.withColumn("orders", F.col("orders").cast("float")))
    values = lambda df: np.array([r.features for r in df.orderBy("id").collect()])
    assert np.allclose(values(made.model.userFactors), values(own.userFactors), rtol=1e-3, atol=1e-5)
    assert np.allclose(values(made.model.itemFactors), values(own.itemFactors), rtol=1e-3, atol=1e-5)


def test_rounds_leave_no_shuffles(spark, monkeypatch):
    # What a half round shuffles is deleted before the next, and so are the factors before it.
    monkeypatch.setattr(recommend, "PURCHASES", 20_000)
    rows = [(c, p, 1) for c in range(3000) for p in range(c % 7, 700, 19)]
    found = spark.createDataFrame(rows, "customer_id long, product_id long, orders long")
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles
    shuffled = lambda: {f.getName(): f.length() for f in map(files().apply, range(files().size())) if f.getName().startswith("shuffle_")}
    staged = lambda: set(Path(session._scratch_root(spark)).glob("factors-*"))
    before, old = shuffled(), staged()
    recommend.train(found, rank=8, rounds=6)
    left = {name: size for name, size in shuffled().items() if name not in before}
    # One half round shuffles the factors of 3000 customers for 5 blocks or more: 0.4 MB.
    assert sum(left.values()) < 1_000_000
    assert len([folder for folder in staged() - old if any(folder.iterdir())]) == 2


def test_strips_keep_the_best_and_ties(monkeypatch):
    monkeypatch.setattr(recommend, "STRIP", 8)
    draw = np.random.default_rng(1)
    users, items = (draw.integers(-2, 3, (n, 3)).astype(np.float32) for n in (9, 41))
    ids = np.arange(100, 141)
    had = np.array([(u, i) for u in range(9) for i in (*ids[u::5], 500)]).T
    row, item, score = recommend._best(users, ids, items, had, 4)
    for u in range(9):
        free = [(-float(users[u] @ items[k]), int(i)) for k, i in enumerate(ids) if i not in set(ids[u::5])]
        assert [*zip(-score[row == u], item[row == u])] == sorted(free)[:4]


def test_suggestions_meet_an_antecedent_once(spark):
    rules = [([x], y, (i * 7 % 5 + 1) / 10) for i, (x, y) in enumerate(itertools.permutations("abcde", 2))]
    rules += [(["a", "b"], "c", 0.9), (["a", "b"], "e", 0.9), (["a", "b"], "c", 0.2), (["c", "e"], "a", 0.8)]
    rows = [(1, ["a", "b"]), (2, ["c", "d", "e"]), (3, ["z"]), (4, [*"abcde"])]
    found = baskets.suggestions(spark.createDataFrame(rows, "order_id long, items array<string>"),
                                spark.createDataFrame(rules, "antecedent array<string>, consequent string, confidence double"))
    want = set()
    for order, items in rows:
        best = {}
        for has, item, sure in rules:
            if set(has) <= set(items) and item not in items:
                best[item] = max(best.get(item, 0), sure)
        want |= {(order, k, item, sure) for k, (item, sure) in enumerate(sorted(best.items(), key=lambda b: (-b[1], b[0]))[:3], 1)}
    assert {(r.order_id, r.place, r.item, r.confidence) for r in found.collect()} == want
    # The join yields antecedents with all that follows from them, which is unfolded after it.
    shown = found._sc._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "simple")
    assert "inline(then" in shown
