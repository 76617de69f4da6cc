import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from hemicycle.functions.vectors import to_vector
from hemicycle.operators import closed_sets as CS
from hemicycle.operators import clusters as C
from hemicycle.operators import features as L
from hemicycle.operators import patterns as P
from hemicycle.operators import representatives as R

RNG = np.random.default_rng(3)
X = np.vstack([RNG.normal(c, 0.3, (40, 5)) for c in ([0, 0, 0, 0, 0], [4, 0, 1, 0, 2], [0, 5, 0, 3, 0])])


@pytest.fixture(scope="module")
def frame(spark):
    df = spark.createDataFrame([(i, [float(v) for v in x], i // 40) for i, x in enumerate(X)], "id int, x array<double>, g int")
    return df.repartition(3).withColumn("features", to_vector(F.col("x")))


def column(df, col):
    return np.array([r[col] for r in df.orderBy("id").select(col).collect()])


def test_gram_matrix_holds_products_sums_and_count(frame):
    ones = np.column_stack([X, np.ones(len(X))])
    assert np.allclose(L.gram_matrix(frame, "x"), ones.T @ ones)
    parts = {(r["g"], r["i"]): r["row"] for r in L.gram_rows(frame, "x", "g").collect()}
    for g in range(3):
        own = ones[g * 40 : g * 40 + 40]
        assert np.allclose([parts[g, i] for i in range(6)], own.T @ own)


def test_svd_scores_rebuild_the_matrix(frame):
    svd = L.fit_svd(frame, "x", 5)
    scores = column(L.svd_scores(frame, "x", svd), "svd")
    assert np.allclose(scores @ svd.v.T, X)
    left = column(L.svd_scores(frame, "x", svd, scaled=False), "svd")
    assert np.allclose(left * svd.s, scores) and np.allclose(left.T @ left, np.eye(5))
    assert np.allclose(svd.s, np.linalg.svd(X)[1])


def test_null_vectors_pass_through_a_projection(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "id int, x array<double>")
    rows = df.select("id", L.project(F.col("x"), np.array([[1.0], [10.0]])).alias("y")).collect()
    assert {r["id"]: r["y"] for r in rows} == {1: [21.0], 2: None}


def test_pca_is_centred_nested_and_sums_to_one(frame):
    model, centred = L.fit_pca(frame, "features", 5)
    ratios = L.explained_variance(model)
    assert sum(ratios) == pytest.approx(1)
    centred_x = X - X.mean(axis=0)
    u, s, vt = np.linalg.svd(centred_x, full_matrices=False)
    assert np.allclose(ratios, s**2 / (s**2).sum())
    two = column(L.pca_project(model, centred, 2).withColumn("p", vector_to_array("pca_features")), "p")
    assert np.allclose(np.abs(two), np.abs(u[:, :2] * s[:2]))


def test_components_for_share():
    assert L.components_for([0.5, 0.4, 0.1], 0.9) == 2
    assert L.components_for([0.5, 0.375, 0.125], 0.875, strict=True) == 3


def test_kmeans_finds_the_groups_and_sweep_prefers_three(frame):
    labelled = C.fit_clusters(frame, "kmeans", 3)
    assert labelled.groupBy("g").agg(F.countDistinct("cluster").alias("n")).agg(F.max("n")).first()[0] == 1
    best = C.sweep(frame, ["features"], [2, 3], ["kmeans", "gmm"]).first()
    assert best["k"] == 3


def test_euclidean_silhouette_matches_brute_force_for_any_blocks(frame):
    labels = np.repeat([0, 1, 2], 40)
    d = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    want = []
    for i in range(len(X)):
        means = [d[i, labels == c].sum() / ((labels == c).sum() - (c == labels[i])) for c in range(3)]
        a, b = means[labels[i]], min(m for c, m in enumerate(means) if c != labels[i])
        want.append((b - a) / max(a, b))
    for rows in (1000, 30):
        found = C.silhouette_euclidean(frame, "x", "id", "g", block_rows=rows)
        assert np.allclose(column(found, "silhouette"), want)


def test_two_rounds_drop_the_noise_cluster(frame):
    out = C.two_rounds(frame.select("id", "x"), "x", noise=1, first_k=3, second_k=2)
    assert out.count() == 80 and out.filter("first_cluster = 1").count() == 0
    assert out.select("cluster").distinct().count() == 2


def test_representatives_match_brute_force(frame):
    found = R.representatives(frame, "g", "x", "id", 4, excluded=[0]).collect()
    for g in (1, 2):
        own = X[g * 40 : g * 40 + 40]
        mean = own.mean(axis=0)
        cos = own @ mean / np.linalg.norm(own, axis=1) / np.linalg.norm(mean)
        ids = [r["id"] for r in sorted(found, key=lambda r: r["rank"]) if r["g"] == g]
        assert ids == [g * 40 + i for i in np.argsort(-cos)[:4]]
    assert {r["g"] for r in found} == {1, 2}


def test_names_are_joined_by_key(spark, frame):
    names = spark.createDataFrame([(2, "two"), (0, "zero")], "g int, name string")
    named = R.named_clusters(frame.select("id", "g"), names, "g")
    assert {r["g"]: r["name"] for r in named.select("g", "name").distinct().collect()} == {0: "zero", 1: None, 2: "two"}


def test_patterns_match_enumeration(spark):
    rows = [(1, ["a", "b", "c"]), (1, ["a", "b"]), (1, ["a"]), (1, ["b", "c"]), (2, ["z", "y"])]
    df = spark.createDataFrame(rows, "cluster int, items array<string>")
    models = P.per_cluster(df, "cluster", [1, 2], min_support=0.5, min_confidence=0.1)
    sets = {(r["cluster"], tuple(r["items"])): r["freq"] for r in P.frequent_sets(models).collect()}
    want = {}
    for c in (1, 2):
        baskets = [set(i) for k, i in rows if k == c]
        for size in (1, 2, 3):
            for combo in itertools.combinations(sorted(set().union(*baskets)), size):
                n = sum(set(combo) <= b for b in baskets)
                if n >= 0.5 * len(baskets):
                    want[c, combo] = n
    assert sets == want
    rules = {(r["antecedent"][0], r["consequent"][0]): r["confidence"] for r in P.association_rules(models).filter("cluster = 1").collect()}
    assert rules["c", "b"] == 1.0 and rules["a", "b"] == pytest.approx(2 / 3)
    predicted = {tuple(r["items"]): r["prediction"] for r in P.predicted_items(models, df).collect()}
    assert predicted["a",] == ["b"] and predicted["a", "b"] == ["c"]


def test_rules_are_matched_by_all_their_words(spark):
    rules = [(1, ["a", "b"], ["c"]), (1, ["b"], ["d"]), (1, ["d", "e", "f"], ["a"]), (2, ["a"], ["z"])]
    rows = [(1, 1, ["b", "a"]), (2, 1, ["b", "a"]), (3, 1, ["a"]), (4, 1, ["f", "e", "d", "x"]), (5, 1, ["b", "c", "d", "a"]),
            (6, 2, ["a", "b"]), (7, 3, ["a"]), (8, 1, None), (9, 1, []), (10, None, ["a"])]
    rules = spark.createDataFrame(rules, "cluster int, antecedent array<string>, consequent array<string>")
    df = spark.createDataFrame(rows, "id int, cluster int, items array<string>")
    found = P.matched_rules(rules, df)
    assert found.columns == ["id", "cluster", "items", "prediction"]
    assert {r["id"]: r["prediction"] for r in found.collect()} == {
        1: ["c", "d"], 2: ["c", "d"], 3: [], 4: ["a"], 5: [], 6: ["z"], 7: [], 8: [], 9: [], 10: []
    }
    assert "UDF" not in found._jdf.queryExecution().toString()


def plain_closed(rows, support):
    """Closed sets of each cluster as intersections of baskets, with their frequency."""
    out = {}
    for c in {c for c, _, _ in rows}:
        baskets = [frozenset(w for w in items or () if w is not None) for k, _, items in rows if k == c]
        need = max(1, math.ceil(round(support * len(baskets), 9)))
        met = set()
        for b in baskets:
            met |= {b} | {b & m for m in met}
        for m in met:
            n = sum(m <= b for b in baskets)
            if m and n >= need:
                out[c, tuple(sorted(m))] = n
    return out


def random_baskets(seed):
    rng = random.Random(seed)
    rows = [(1, k, rng.sample("abcdefgh", rng.randint(0, 6))) for k in range(90)]
    long = [f"w{k:02}" for k in range(60)]
    rows += [(2, 100 + k, [*long, "x", "x"] if k % 2 else [*long[:30], "y"]) for k in range(10)]
    return rows + [(3, 200, None), (3, 201, ["a", None]), (3, 202, ["a", "b"]), (None, 300, ["a"])]


@pytest.mark.parametrize("support", [0.05, 0.3])
def test_closed_sets_rules_and_predictions(spark, support):
    rows = random_baskets(3)
    df = spark.createDataFrame(rows, "cluster int, basket int, items array<string>")
    found = CS.closed_sets(df, "cluster", "basket", "items", support)
    rows = [r for r in rows if r[0] is not None]
    want = plain_closed(rows, support)
    assert {(r.cluster, tuple(r["items"])): r.freq for r in CS.frequent_closed_sets(found).collect()} == want

    held = {b: (c, frozenset(w for w in items or () if w)) for c, b, items in rows}
    size = {c: sum(k == c for k, _ in held.values()) for c in (1, 2, 3)}
    rules, told = {}, {b: set() for b in held}
    for (c, d), n in want.items():
        for w in {w for k, b in held.values() if k == c for w in b} - set(d):
            both = sum(k == c and {*d, w} <= b for k, b in held.values())
            if both >= max(1, math.ceil(round(support * size[c], 9))) and both / n >= 0.1:
                alone = sum(k == c and w in b for k, b in held.values())
                rules[c, d, w] = (both / n, both / n / (alone / size[c]), both / size[c])
                for b, (k, words) in held.items():
                    if k == c and set(d) <= words and w not in words:
                        told[b].add(w)
    got = {(r.cluster, tuple(r.antecedent), r.consequent[0]): (r.confidence, r.lift, r.support) for r in CS.closed_rules(found).collect()}
    assert got.keys() == rules.keys() and all(v == pytest.approx(rules[k]) for k, v in got.items())
    assert {r.basket: r.prediction for r in CS.predicted_words(found, "basket").collect()} == {b: sorted(w) for b, w in told.items()}


def test_closed_sets_say_as_much_as_all_frequent_sets(spark):
    """Frequencies of all sets that FP-growth lists follow from the closed ones; infrequent sets have none."""
    rows = [r for r in random_baskets(3) if r[0] == 1]
    df = spark.createDataFrame(rows, "cluster int, basket int, items array<string>")
    found = CS.closed_sets(df, "cluster", "basket", "items", 0.05)
    listed = P.frequent_sets(P.per_cluster(df, "cluster", [1], min_support=0.05)).select("cluster", "items", F.col("freq").alias("want"))
    rare = spark.createDataFrame([(1, list("abcdefgh"), None), (1, ["a", "zz"], None)], "cluster int, items array<string>, want long")
    asked = listed.unionByName(rare)
    got = CS.frequency_of(found, asked).collect()
    assert len(got) == listed.count() + 2 > 50 and all(r.freq == r.want for r in got)


def test_closed_sets_of_no_baskets(spark):
    df = spark.createDataFrame([], "cluster int, basket int, items array<string>")
    found = CS.closed_sets(df, "cluster", "basket")
    assert CS.frequent_closed_sets(found).count() == CS.closed_rules(found).count() == CS.predicted_words(found, "basket").count() == 0


def test_second_round_does_not_run_the_python_of_the_first(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.normal(size=3) + 9 * (i % 8)]) for i in range(64)]
    labelled = C.two_rounds(spark.createDataFrame(rows, "id int, v array<double>"), "v", 0)
    assert labelled._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert 0 < labelled.count() < 64
