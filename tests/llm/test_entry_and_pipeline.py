import pathlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from check_oracle import rows_of
from hemicycle.llm import importance
from hemicycle.llm.registry import ORACLES, QUERIES

from .conftest import ODD, make
from .test_native import measures, plain_exact, plain_mix
from .test_near_and_tokens import ids_of, plain_components, plain_print

SMALL = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) < set(entry_point.queries()) and "pipeline" in entry_point.queries()


@pytest.mark.skipif(not pathlib.Path(SMALL).exists(), reason="tables not present")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("documents", "embeddings", "labels"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    result = con.execute(ORACLES[name])
    columns, rows = [c[0] for c in result.description], result.fetchall()
    df = QUERIES[name](spark, SMALL)
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, rows)


def plain_pipeline(rows):
    """Rows that the stages before packing leave, each as often as the mixture reads it."""
    judged = [(r, measures(r[1])) for r in rows]
    rows = [r for r, m in judged if m[0] >= 50 and 100 * m[4] <= 50 * m[0]]
    kept = Counter(r[0] for r in plain_exact(rows) if r[3])
    firsts = []
    for r in rows:
        if kept[r[0]]:
            kept[r[0]] -= 1
            firsts.append(r)
    roots = plain_components([(i, plain_print(t)) for i, t, _ in firsts])
    left = [r for r, (i, _, c) in zip(firsts, roots) if i == c]
    return Counter({r: n for r, n in zip(left, plain_mix(left, corpus_pipeline.MIX))})


def test_pipeline_against_a_plain_version(spark, tmp_path):
    rng = random.Random(8)
    text = lambda n: " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 400)) for _ in range(n))
    rows = [(k, text(rng.randint(20, 400)), f"s{k % 5}" if k % 3 else "hot") for k in range(90)]
    rows += [(200 + k, rows[k][1].replace(" ", "\n", 3), "copy") for k in range(0, 90, 6)]
    rows += [(300 + k, rows[k][1] + " tail", "near") for k in range(0, 90, 5)]
    rows += [(400 + k, "spam spam egg " * 30, "spam") for k in range(5)] + [(500, None, None), (501, "", "a")]
    make(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    want = plain_pipeline(rows)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {i: [*x, 1] for (i, t, _), x in zip(want, ids_of([t for _, t, _ in want]))}
    assert Counter({i: sum(r.length for r in got if r.doc_id == i) for i in ids}) == Counter(
        {r[0]: n * len(ids[r[0]]) for r, n in want.items()}
    )
    for r in got:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4")
        assert zlib.crc32(part.tobytes()) == r.ids_crc32
    lengths = Counter()
    for r in got:
        lengths[r.sequence_id] += r.length
    assert max(lengths.values()) <= 2048


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_odd_documents(spark, clashing, nothing, stage):
    function = corpus_pipeline.STAGES[stage][1]
    got = function(spark, clashing, "")
    assert stage == 4 or got.columns == clashing.columns
    assert got.count() >= (0 if stage == 0 else 1)
    assert function(spark, nothing, "").count() == 0


ALL = (1 << 64) - 1


def plain_mixed(x):
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & ALL
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & ALL
    return x ^ x >> 31


def plain_hash(values):
    """Hash of a run: its values over powers of an odd number, on whole numbers of Python."""
    base = 0x9E3779B97F4A7C15
    return plain_mixed((sum(v * pow(base, k, 1 << 64) for k, v in enumerate(values)) + len(values)) & ALL)


def plain_buckets(text, n):
    """Buckets of the words and pairs of words of a text, one at a time."""
    byte = lambda b: plain_mixed((b + 1) * 0x9E3779B97F4A7C15 & ALL)
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    words = [plain_hash([byte(b + 32 if 65 <= b <= 90 else b) for b in w]) for w in words]
    grams = [plain_hash([w]) for w in words] + [plain_hash([a, b]) for a, b in zip(words, words[1:])]
    return np.array([g % n for g in grams], dtype=np.int64)


def test_importance_against_a_plain_version(spark, clashing, nothing):
    good = spark.createDataFrame([(4,), (7,), (9,), (9,), (None,)], "doc_id long")
    sampler = importance.Sampler(buckets=50)
    got = importance.importance_sample(clashing, good, 0.5, sampler).collect()
    raw, wanted = np.ones(50), np.ones(50)
    for i, t, _ in ODD:
        found = np.bincount(plain_buckets(t, 50), minlength=50)
        raw += found
        wanted += found if i in (4, 7, 9) else 0
    ratios = np.log(wanted / wanted.sum()) - np.log(raw / raw.sum())
    want = {i: ratios[plain_buckets(t, 50)].sum() for i, t, _ in ODD if i is not None}
    for r in got:
        if r.doc_id is not None:
            assert abs(r.log_ratio - want[r.doc_id]) < 1e-6
    assert len(got) == len(ODD)
    scores = sorted((r.score for r in got), reverse=True)
    assert all(r.kept == (r.score >= scores[round(0.5 * len(ODD)) - 1]) for r in got)
    for share, kept in ((0.0, False), (1.0, True)):
        assert {r.kept for r in importance.importance_sample(clashing, good, share, sampler).collect()} == {kept}
    assert importance.importance_sample(nothing, good, 0.5, sampler).count() == 0
    none = spark.createDataFrame([], "doc_id long")
    assert importance.importance_sample(clashing, none, 0.5, sampler).count() == len(ODD)


def test_words_are_told_apart_by_ascii_space_and_joined_texts():
    a, _ = importance.ngram_buckets([b"One two", b"", b"three  FOUR\n"], 1 << 40)
    b, _ = importance.ngram_buckets([b"one two"], 1 << 40)
    c, of = importance.ngram_buckets([b"three four"], 1 << 40)
    assert sorted(a) == sorted([*b, *c]) and len(of) == 3


@pytest.mark.parametrize("k", [1, 2, 57, 300, 301])
def test_rank_value(spark, monkeypatch, k):
    monkeypatch.setattr(importance, "BINS", 5)
    values = [random.Random(3).randint(-(10**12), 10**12) for _ in range(200)] + [7] * 100
    rows = spark.createDataFrame([(v,) for v in values], "v long")
    want = sorted(values, reverse=True)[k - 1] if k <= 300 else None
    assert importance.rank_value(rows, "v", k) == want


@pytest.mark.skipif(not pathlib.Path("/root/testdata/sf0.1").exists(), reason="tables not present")
def test_held_out_labels(spark):
    """Documents of labels that did not fit the models are told apart."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    fit = labels.where("quality = 1 and doc_id % 2 = 0").select("doc_id")
    scored = importance.importance_sample(docs, fit, 0.85).join(labels.where("doc_id % 2 = 1"), "doc_id")
    kept = {r.quality: r.share for r in scored.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert kept[1] > 0.95 and kept[0] < 0.1
