import numpy as np
import pytest
from pyspark.sql import functions as F

from hemicycle.operators import splitting as X

RNG = np.random.default_rng(7)
MIDDLES = np.array([[0, 0, 0], [9, 0, 0], [0, 9, 4], [9, 9, -5]])
DATA = np.vstack([RNG.normal(m, 0.4, (30, 3)) for m in MIDDLES])


def frame(spark, rows):
    return spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "id int, x array<double>").repartition(3)


def plain_labels(x, centres):
    return np.array([min(range(len(centres)), key=lambda c: (((row - centres[c]) ** 2).sum(), c)) for row in x])


def plain_sets(x, max_k, rounds):
    """The same sets, each pass over the whole matrix."""
    sets, passes = [x.mean(axis=0)[None]], max_k - 1 + rounds
    for _ in range(passes):
        labels = [plain_labels(x, s) for s in sets]
        moved = [np.array([x[f == c].mean(axis=0) if (f == c).any() else s[c] for c in range(len(s))]) for f, s in zip(labels, sets)]
        if len(sets) < max_k:
            parts = [x[labels[-1] == c] for c in range(len(sets))]
            scatter = [((p - p.mean(axis=0)) ** 2).sum(axis=0) if len(p) else np.zeros(x.shape[1]) for p in parts]
            widest = int(np.argmax([s.sum() for s in scatter]))
            i = int(np.argmax(scatter[widest]))
            step = np.zeros(x.shape[1])
            step[i] = np.sqrt(scatter[widest][i] / len(parts[widest]))
            low = moved[-1].copy()
            low[widest] -= step
            moved.append(np.vstack([low, moved[-1][widest] + step]))
        sets = moved
    return sets


def plain_silhouette(x, labels):
    square = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    values = []
    for i, own in enumerate(labels):
        if (labels == own).sum() == 1:
            values.append(0.0)
            continue
        a = square[i][labels == own].sum() / ((labels == own).sum() - 1)
        b = min(square[i][labels == c].mean() for c in set(labels) if c != own)
        values.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return np.mean(values)


def test_all_sets_match_a_plain_version(spark):
    df = frame(spark, DATA.tolist())
    found = X.split_sets(df, "x", 6, 4)
    wanted = plain_sets(DATA, 6, 4)
    assert [len(c) for c in found.centres] == [1, 2, 3, 4, 5, 6]
    assert all(np.allclose(a, b) for a, b in zip(found.centres, wanted))
    names = [f"k{k}" for k in range(1, 7)]
    rows = X.with_split_labels(df, "x", found.centres, names).orderBy("id").collect()
    for k, (name, centres) in enumerate(zip(names, wanted)):
        labels = plain_labels(DATA, centres)
        assert [r[name] for r in rows] == labels.tolist()
        assert found.sizes[k].tolist() == [int((labels == c).sum()) for c in range(k + 1)]
        assert found.spreads[k].sum() == pytest.approx(((DATA - centres[labels]) ** 2).sum())
        if k:
            assert found.silhouettes[k] == pytest.approx(plain_silhouette(DATA, labels))


def test_the_score_prefers_the_true_count_and_sets_are_fixed_points(spark):
    found = X.split_sets(frame(spark, DATA.tolist()), "x", 6, 30, tolerance=1e-12)
    best = found.scores(spark).filter("k > 1").orderBy(F.desc("silhouette")).first()
    assert (best["k"], best["filled"]) == (4, 4)
    assert np.isnan(found.silhouettes[0])
    for centres in found.centres:
        labels = plain_labels(DATA, centres)
        assert all(np.allclose(DATA[labels == c].mean(axis=0), centres[c]) for c in set(labels))


def test_inertia_never_rises_with_more_rounds(spark):
    df = frame(spark, DATA.tolist())
    few, many = X.split_sets(df, "x", 5, 1), X.split_sets(df, "x", 5, 6)
    assert all(b.sum() <= a.sum() + 1e-9 for a, b in zip(few.spreads, many.spreads))


def test_far_from_the_origin(spark):
    near = X.split_sets(frame(spark, DATA.tolist()), "x", 4, 3)
    far = X.split_sets(frame(spark, (DATA + 1e6).tolist()), "x", 4, 3)
    assert [n.tolist() for n in near.sizes] == [n.tolist() for n in far.sizes]
    assert all(np.allclose(a.sum(), b.sum(), rtol=1e-4) for a, b in zip(near.spreads, far.spreads))


def test_unusable_vectors_get_no_label_and_other_columns_stay(spark):
    rows = [[0.0, 0.0], None, [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [8.0, 8.0], [0.0, 1.0], [8.0, 9.0]]
    df = frame(spark, rows).withColumns({"cluster": F.lit("mine"), "slot": F.lit(None).cast("long")})
    found = X.split_sets(df, "x", 2, 3)
    assert sorted(found.sizes[1].tolist()) == [2, 2]
    out = X.with_split_labels(df, "x", found.centres[1:], ["k2"]).orderBy("id").collect()
    assert [r["k2"] is None for r in out] == [False, True, True, True, True, False, False, False]
    assert out[0]["k2"] == out[6]["k2"] != out[5]["k2"] == out[7]["k2"]
    assert {(r["cluster"], r["slot"]) for r in out} == {("mine", None)}
    with pytest.raises(ValueError):
        X.with_split_labels(df, "x", found.centres[1:], ["cluster"])


def test_more_sets_than_different_rows(spark):
    found = X.split_sets(frame(spark, [[1.0], [1.0], [1.0], [5.0]]), "x", 5, 2)
    assert [int((n > 0).sum()) for n in found.sizes] == [1, 2, 2, 2, 2]
    assert all(n.sum() == 4 for n in found.sizes)
    assert all(w.sum() == pytest.approx(0.0) for w in found.spreads[1:])


@pytest.mark.parametrize("rows", [[], [None], [[None, 1.0]]])
def test_nothing_to_fit(spark, rows):
    found = X.split_sets(frame(spark, rows), "x", 3)
    assert found.centres == [] and found.scores(spark).count() == 0


def test_a_vector_of_another_length_is_an_error(spark):
    with pytest.raises(Exception, match="must all have"):
        X.split_sets(frame(spark, [[1.0, 2.0], [1.0]]).coalesce(1), "x", 2)


def test_queries_over_an_empty_table(spark, tmp_path):
    from hemicycle.plans import QUERIES

    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    empty.write.parquet(str(tmp_path / "embeddings.parquet"))
    for name, columns in (("split_labels", ["vec_id", "k", "cluster"]), ("split_sweep", ["k", "filled", "inertia", "silhouette"])):
        df = QUERIES[name](spark, str(tmp_path))
        assert df.columns == columns and df.count() == 0
