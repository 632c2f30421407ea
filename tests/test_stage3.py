"""Stage 3: lookups and recommendations — edge cases and brute-force checks."""

import itertools
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from posgraph.operators import lookups, recommend
from posgraph.operators.pairs import basket_pairs
from tests.conftest import graph_of


def test_history_duplicate_doubles_paths_but_is_one_link(spark):
    g = graph_of(spark, [
        ("T", "A", "e1", "20240102T000000"),
        ("T", "A", "e2", "20240101T000000"),
        ("U", "A", "e3", "20240101T000000"),
        ("U", "B", "e4", "20240101T000000"),
    ])
    r = recommend.item_recommendations(g, "T", similarity_threshold=0.0).collect()
    assert [x.product_id for x in r] == ["B"]
    # paths = 2 (history repeat) * 1, deg_A = 3, deg_B = 1 -> s = 2 / (3 + 1 - 2) = 1
    assert r[0].related_items_count == 1
    assert r[0].recommendation_score == pytest.approx(round(1.0 * math.log(2), 6))


def test_zero_denominator_pair_is_dropped(spark):
    g = graph_of(spark, [
        ("T", "A", "e1", "20240103T000000"),
        ("T", "A", "e2", "20240102T000000"),
        ("T", "B", "e3", "20240101T000000"),
        ("T", "B", "e4", "20240101T000000"),
    ])
    # history = newest 2 rows = A twice; paths(A,B) = 2 * 2 * 2 = 8; deg 2 + 2 - 8 < 0 -> dropped
    assert recommend.item_recommendations(g, "T", similarity_threshold=0.0,
                                          max_history_items=2).count() == 0
    # buyers counting: one buyer of both -> Jaccard 1
    r = recommend.item_recommendations(g, "T", similarity_threshold=0.0, max_history_items=2,
                                       counting="buyers").collect()
    assert [x.product_id for x in r] == ["B"]


def test_user_cf_zero_overlap_kept_and_owned_never_returned(spark):
    g = graph_of(spark, [
        ("T", "A", "1", "x"), ("T", "B", "2", "x"),
        ("U", "A", "3", "x"), ("U", "C", "4", "x"),
        ("V", "D", "5", "x"),            # shares nothing with T
    ])
    sims = {r.person_id: r.similarity for r in recommend.user_similarity(g, "T").collect()}
    assert sims == {"U": pytest.approx(1 / 3), "V": 0.0}
    rows = recommend.user_recommendations(g, "T").collect()
    assert {r.product_id for r in rows} == {"C", "D"}
    d = [r for r in rows if r.product_id == "D"][0]
    assert d.similar_user_id == "V" and d.similarity == 0.0 and d.recommendation_score == 0.0
    assert recommend.user_recommendations(g, "T", similarity_threshold=0.1).select("product_id") \
        .distinct().collect()[0].product_id == "C"


def test_target_without_purchases(spark):
    g = graph_of(spark, [("U", "A", "1", "x")], persons=["T", "U"])
    assert recommend.user_recommendations(g, "T").count() == 0
    assert recommend.item_recommendations(g, "T").count() == 0
    s = lookups.person_statistics(g, "T").collect()
    assert len(s) == 1
    assert (s[0].total_purchases, s[0].total_quantity, s[0].total_amount, s[0].avg_amount,
            s[0].categories) == (0, 0, 0, None, [])
    allp = {r.person_id: r.total_purchases for r in lookups.person_statistics_all(g).collect()}
    assert allp == {"T": 0, "U": 1}


def test_rule_passing_only_on_reverse_confidence(spark):
    edges = [(f"P{i}", "A", f"a{i}", "x") for i in range(10)] + [("P0", "B", "b0", "x")]
    g = graph_of(spark, edges)
    r = recommend.association_rules(g, min_support=0.0, min_confidence=0.5).collect()
    assert [(x.antecedent_id, x.consequent_id) for x in r] == [("A", "B")]
    assert r[0].confidence == pytest.approx(0.1) and r[0].support == pytest.approx(0.1)
    assert r[0].lift == pytest.approx(0.1 / (1 / 10))
    both = recommend.association_rules(g, min_support=0.0, min_confidence=0.5, both_directions=True)
    assert both.count() == 2


def test_person_purchases_order_and_date_bounds(spark):
    g = graph_of(spark, [
        ("T", "A", "1", "20240101T100000"),
        ("T", "B", "2", None),
        ("T", "C", "3", "20240301T100000"),
    ])
    assert [r.product_id for r in lookups.person_purchases(g, "T").collect()] == ["B", "C", "A"]
    ranged = lookups.person_purchases(g, "T", start_date="2024-01-01", end_date="2024-01-31").collect()
    assert [r.product_id for r in ranged] == ["A"]
    top1 = {r.person_id: r.product_id for r in lookups.person_purchases_all(g, 1).collect()}
    assert top1 == {"T": "B"}
    buyers = lookups.product_purchasers(g, "A").collect()
    assert [(r.person_id, r.gender) for r in buyers] == [("T", "1")]


def _random_graph(seed, persons=12, items=8, edges=60):
    rnd = random.Random(seed)
    rows = []
    for i in range(edges):
        p = f"U{rnd.randrange(persons):02d}"
        q = f"I{rnd.randrange(items):02d}"
        rows.append((p, q, f"e{i}", f"2024{rnd.randrange(1, 13):02d}01T000000"))
    # one heavy basket
    rows += [("U99", f"I{k:02d}", f"h{k}", "20240101T000000") for k in range(items)]
    return rows


def _brute_rules(rows, min_support, min_conf):
    persons = {p for p, *_ in rows}
    baskets = defaultdict(set)
    cnt = Counter()
    for p, q, *_ in rows:
        baskets[p].add(q)
        cnt[q] += 1
    both = Counter()
    for items in baskets.values():
        for a, b in itertools.combinations(sorted(items), 2):
            both[(a, b)] += 1
    out = {}
    n = len(persons)
    for (a, b), k in both.items():
        sup, cab, cba = k / n, k / cnt[a], k / cnt[b]
        if sup >= min_support and (cab >= min_conf or cba >= min_conf):
            out[(a, b)] = (round(sup, 6), round(cab, 6), round(cab / (cnt[b] / n), 6))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_association_rules_brute_force_with_and_without_prefilter(spark, seed):
    rows = _random_graph(seed)
    g = graph_of(spark, rows)
    want = _brute_rules(rows, 0.1, 0.3)
    for prefilter, chunk in ((False, 2048), (True, 2048), (True, 3)):
        got = recommend.association_rules(g, 0.1, 0.3, limit=None, prefilter=prefilter, chunk=chunk)
        got = {(r.antecedent_id, r.consequent_id): (r.support, r.confidence, r.lift) for r in got.collect()}
        assert got.keys() == want.keys()
        for k in want:
            assert got[k] == pytest.approx(want[k], abs=1e-6)


def test_basket_pairs_split_equals_plain_pairs(spark):
    rnd = random.Random(7)
    rows = sorted({(f"u{rnd.randrange(4)}", f"i{rnd.randrange(25):02d}") for _ in range(70)})
    df = spark.createDataFrame(rows, "person_id string, product_id string")
    want = Counter()
    baskets = defaultdict(set)
    for p, q in rows:
        baskets[p].add(q)
    for p, items in baskets.items():
        for a, b in itertools.combinations(sorted(items), 2):
            want[(p, a, b)] += 1
    for chunk in (1, 3, 1000):
        got = Counter(tuple(r) for r in basket_pairs(df, chunk=chunk).collect())
        assert got == want


def _brute_item_cf(rows, target, threshold, hist_n):
    m = Counter((p, q) for p, q, *_ in rows)
    deg = Counter(q for _, q, *_ in rows)
    mine = sorted([r for r in rows if r[0] == target], key=lambda r: (r[1], r[2]))
    # newest first, null times first; ties keep (product, id) order (stable sort)
    mine = sorted(mine, key=lambda r: (r[3] is None, r[3] or ""), reverse=True)[:hist_n]
    rep = Counter(r[1] for r in mine)
    persons = {p for p, *_ in rows}
    items = {q for _, q, *_ in rows}
    sims = defaultdict(list)
    for h, k in rep.items():
        for c in items - set(rep):
            paths = k * sum(m[(u, h)] * m[(u, c)] for u in persons)
            if paths == 0:
                continue
            den = deg[h] + deg[c] - paths
            if den == 0:
                continue
            s = paths / den
            if s >= threshold:
                sims[c].append(s)
    return {c: (round(sum(v) * math.log(len(v) + 1), 6), len(v)) for c, v in sims.items()}


@pytest.mark.parametrize("seed", [3, 4])
def test_item_cf_brute_force(spark, seed):
    rows = _random_graph(seed)
    g = graph_of(spark, rows)
    target = rows[0][0]
    want = _brute_item_cf(rows, target, 0.05, 4)
    got = recommend.item_recommendations(g, target, limit=None, similarity_threshold=0.05,
                                         max_history_items=4).collect()
    got = {r.product_id: (r.recommendation_score, r.related_items_count) for r in got}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][1] == want[k][1] and got[k][0] == pytest.approx(want[k][0])


def test_related_products_counts_distinct_buyers(spark):
    g = graph_of(spark, [
        ("U1", "X", "1", "x"), ("U1", "Y", "2", "x"), ("U1", "Y", "3", "x"),
        ("U2", "X", "4", "x"), ("U2", "Y", "5", "x"), ("U2", "Z", "6", "x"),
        ("U3", "Z", "7", "x"),
    ])
    r = recommend.related_products(g, "X").collect()
    assert [(x.product_id, x.frequency) for x in r] == [("Y", 2), ("Z", 1)]


def test_salted_join_equals_plain_join(spark):
    from posgraph.operators.skew import salted_join
    rnd = random.Random(11)
    big = spark.createDataFrame([(f"k{rnd.randrange(3) if i % 2 else 0}", i) for i in range(60)],
                                "k string, v int")
    small = spark.createDataFrame([("k0", "a"), ("k1", "b"), ("k9", "z")], "k string, s string")
    counts = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    want = sorted(tuple(r) for r in big.join(small, "k").collect())
    for per_task in (1, 4, 1000):
        got = sorted(tuple(r) for r in salted_join(big, small, "k", counts, per_task=per_task).collect())
        assert got == want
    semi = salted_join(big, small, "k", counts, how="left_semi", per_task=3)
    assert sorted(tuple(r) for r in semi.collect()) == sorted(tuple(r) for r in big.join(small, "k", "left_semi").collect())


def test_skew_and_fallback_paths_give_the_same_answers(spark):
    rows = _random_graph(5) + [("U99", f"I{k:02d}", f"x{k}", "20240301T000000") for k in range(8)]
    g = graph_of(spark, rows)
    target = "U99"
    runs = {
        "user": lambda: recommend.user_recommendations(g, target, limit=None),
        "item": lambda: recommend.item_recommendations(g, "U01", limit=None, similarity_threshold=0.0),
        "related": lambda: recommend.related_products(g, "I00", limit=None),
        "rules": lambda: recommend.association_rules(g, 0.05, 0.1, limit=None),
        "lookup": lambda: lookups.person_purchases(g, target, limit=None),
    }
    plain = {k: sorted(tuple(r) for r in f().collect()) for k, f in runs.items()}
    spark.conf.set("posgraph.skew.rowsPerTask", "2")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        forced = {k: sorted(tuple(r) for r in f().collect()) for k, f in runs.items()}
    finally:
        spark.conf.unset("posgraph.skew.rowsPerTask")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    for k in runs:
        assert forced[k] == plain[k], k


@pytest.mark.parametrize("parts", [3, 11])
def test_results_do_not_depend_on_partition_count(spark, parts):
    rows = _random_graph(9)
    g = graph_of(spark, rows)
    runs = {
        "rules": lambda: recommend.association_rules(g, 0.05, 0.1, limit=None),
        "user": lambda: recommend.user_recommendations(g, rows[0][0], limit=3),
        "all": lambda: lookups.person_purchases_all(g, 2),
    }
    before = {k: sorted(tuple(r) for r in f().collect()) for k, f in runs.items()}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        after = {k: sorted(tuple(r) for r in f().collect()) for k, f in runs.items()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert before == after


@pytest.mark.parametrize("seed", [12, 13])
def test_buyer_counting_similarity_is_a_jaccard_index(spark, seed):
    rows = _random_graph(seed)
    g = graph_of(spark, rows)
    s = [r.s for r in recommend.item_similarity(g, rows[0][0], 5, counting="buyers").collect()]
    assert s and all(x is not None and 0.0 < x <= 1.0 for x in s)
    us = [r.similarity for r in recommend.user_similarity(g, rows[0][0]).collect()]
    assert us and all(0.0 <= x <= 1.0 for x in us)


def test_limit_zero_gives_no_rows(spark):
    from posgraph.operators import reports
    g = graph_of(spark, [("T", "A", "1", "x"), ("T", "B", "2", "x"), ("U", "A", "3", "x"), ("U", "C", "4", "x")])
    frames = [lookups.person_purchases(g, "T", 0), lookups.person_purchases_all(g, 0), lookups.product_purchasers(g, "A", 0),
              lookups.product_purchasers_all(g, 0), recommend.related_products(g, "A", 0),
              recommend.user_recommendations(g, "T", 0), recommend.item_recommendations(g, "T", 0),
              recommend.association_rules(g, 0.0, 0.0, 0),
              reports.top_products(spark.createDataFrame([("A", 1, 1)], "product_id string, purchase_details_quantity int, "
                                                         "purchase_details_amount int"), 0)]
    assert [f.count() for f in frames] == [0] * len(frames)


@pytest.mark.parametrize("threshold", [0.0, 0.05])
def test_user_cf_rows_are_in_order_and_exact(spark, threshold):
    rows = _random_graph(4)
    g = graph_of(spark, rows)
    target = rows[0][0]
    got = recommend.user_recommendations(g, target, 5, threshold).collect()
    key = [(-r.recommendation_score, r.product_id, -r.similarity, r.similar_user_id) for r in got]
    assert key == sorted(key) and [r["rank"] for r in got] == sorted(r["rank"] for r in got)
    baskets = defaultdict(set)
    for p, q, *_ in rows:
        baskets[p].add(q)
    mine = baskets[target]
    sim = {p: len(b & mine) / len(b | mine) for p, b in baskets.items() if p != target}
    for r in got:
        users = [p for p in sim if r.product_id in baskets[p] and sim[p] >= threshold]
        assert r.purchase_count == len(users) and r.similarity == sim[r.similar_user_id]
        assert r.recommendation_score == pytest.approx(sum(sim[p] for p in users) * math.log(len(users) + 1), rel=1e-12)


def test_rules_are_in_order_and_small_supports_survive(spark):
    rows = _random_graph(6)
    g = graph_of(spark, rows)
    got = recommend.association_rules(g, 0.0, 0.0, 10).collect()
    key = [(-r.lift, r.antecedent_id, r.consequent_id) for r in got]
    assert key == sorted(key) and [r["rank"] for r in got] == list(range(1, len(got) + 1))
    g = graph_of(spark, [("T", "A", "1", "x"), ("T", "B", "2", "x")])
    g.person = spark.range(4_000_000).select(F.col("id").cast("string").alias("id"))
    r = recommend.association_rules(g, 0.0, 0.0, 10).collect()
    assert [x.support for x in r] == [1 / 4_000_000]
