import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from hemicycle import scale
from hemicycle.operators import explore


def test_rows_are_numbered_without_gaps(spark):
    df = spark.createDataFrame([("g" if i % 3 else "h", i) for i in range(500)], "g string, i int")
    bucket = scale.hash_bucket(F.col("i").cast("string"), 16)
    runs = []
    for n in (1, 7):
        out = scale.number_rows(df.repartition(n), ["g"], F.col("i"), bucket, "nth").collect()
        runs.append(sorted(tuple(r) for r in out))
        for g in "gh":
            nth = sorted(r["nth"] for r in out if r["g"] == g)
            assert nth == list(range(1, len(nth) + 1))
    assert runs[0] == runs[1]


def test_describe_matches_pandas(spark):
    rng = random.Random(5)
    rows = [(rng.choice([1, 1, 2, 3]), rng.lognormvariate(0, 3)) for _ in range(600)] + [(4, 7.0), (1, None)]
    rows += [(2, 5.0)] * 50 + [(1, 1e12), (2, float("nan")), (3, -1e12)]
    df = spark.createDataFrame(rows, "c int, v double")
    found = explore.describe(df, "v", "c").toPandas().set_index("c").sort_index()
    want = pd.DataFrame(rows, columns=["c", "v"]).groupby("c")["v"].describe()
    assert np.allclose(found.to_numpy(float), want.to_numpy(float), equal_nan=True)
    overall = explore.describe(df, "v").toPandas().to_numpy(float)[0]
    assert np.allclose(overall, pd.DataFrame(rows, columns=["c", "v"])["v"].describe().to_numpy(float))


def test_histogram_folds_the_maximum_into_the_last_bin(spark):
    df = spark.range(0, 101).select(F.col("id").alias("v"))
    rows = {r["bin"]: r["count"] for r in explore.histogram(df, "v", 100).collect()}
    assert rows[100] == 2 and rows[1] == 1 and max(rows) == 100
    same = spark.createDataFrame([(3.0,)] * 4 + [(float("nan"),), (None,)], "v double")
    assert [(r["bin"], r["count"]) for r in explore.histogram(same, "v", 100).collect()] == [(1, 4)]


def test_pivot_fills_zero_and_top_words_break_ties_by_word(spark):
    df = spark.createDataFrame([(2016, 1), (2016, 1), (2017, 2), (2017, 9)], "year int, cluster int")
    rows = {r["year"]: (r["cluster_1"], r["cluster_2"]) for r in explore.count_pivot(df, "year", "cluster", [1, 2]).collect()}
    assert rows == {2016: (2, 0), 2017: (0, 1)}
    assert explore.count_pivot(df, "year", "cluster").columns == ["year", "cluster_1", "cluster_2", "cluster_9"]
    words = spark.createDataFrame([(1, ["b", "a", "c", "c"])], "cluster int, w array<string>")
    top = explore.top_words(words, "cluster", "w", 2).orderBy("rank").collect()
    assert [(r["word"], r["count"]) for r in top] == [("c", 2), ("a", 1)]


def test_samples_have_exact_size_and_repeat(spark):
    df = spark.createDataFrame([(i, 0 if i < 300 else 1 if i < 304 else 2) for i in range(350)], "id int, c int")
    five = explore.sample_n(df, "c", "id", 5)
    assert {r["c"]: r["count"] for r in five.groupBy("c").count().collect()} == {0: 5, 1: 4, 2: 5}
    draws = [sorted(r["id"] for r in explore.sample_fraction(df.repartition(n), "c", "id", 0.1).collect()) for n in (1, 9)]
    assert draws[0] == draws[1]
    assert len(draws[0]) == 30 + 0 + 5
    plain = df.withColumn("k", explore.draw_key(42, "id")).toPandas()
    assert sorted(plain[plain.c == 0].sort_values("k").id[:30]) == [i for i in draws[0] if i < 300]


def test_wide_table_has_nulls_for_short_clusters(spark):
    df = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (1, 2, "c")], "rank int, cluster int, t string")
    rows = {r["rank"]: (r["cluster_1"], r["cluster_2"]) for r in explore.wide_by_rank(df, "rank", "cluster", "t", [1, 2]).collect()}
    assert rows == {1: ("a", "c"), 2: ("b", None)}


def test_top_n_is_cut_before_the_shuffle(spark):
    plan = explore.sample_n(spark.range(100).withColumn("c", F.col("id") % 3), "c", "id")
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()
