import collections

import pytest
from pyspark.sql import functions as F

from hemicycle.operators import lemma_rules as R
from hemicycle.operators.normalize import normalize_tokens

TABLE = [
    ("casas", "casa"), ("mesas", "mesa"), ("leyes", "ley"), ("reyes", "rey"), ("voces", "voz"), ("luces", "luz"),
    ("veces", "vez"), ("casa", "casa"), ("mesa", "mesa"), ("fue", "ser"), ("y", "y"), ("ñandúes", "ñandú"), ("bambúes", "bambú"),
]


def lemma_table(spark, rows):
    return spark.createDataFrame(rows, "word string, lemma string")


def plain_rules(pairs, max_suffix, min_count, min_share):
    seen = collections.defaultdict(collections.Counter)
    for word, lemma in set(pairs):
        p = 0
        while p < min(len(word), len(lemma)) and word[p] == lemma[p]:
            p += 1
        for n in range(1, min(max_suffix, len(word) - 1) + 1):
            seen[word[-n:]][(len(word) - p, lemma[p:]) if len(word) - p <= n else None] += 1
    rules = {}
    for suffix, edits in seen.items():
        known = [(-n, *e) for e, n in edits.items() if e is not None]
        if known:
            n, cut, added = min(known)
            if -n >= min_count and -n / sum(edits.values()) >= min_share:
                rules[suffix] = (cut, added, -n, -n / sum(edits.values()))
    return rules


def plain_lemma(word, rules, max_suffix):
    for n in range(min(max_suffix, len(word) - 1), 0, -1):
        if word[-n:] in rules:
            cut, added = rules[word[-n:]][:2]
            return word[: len(word) - cut] + added, word[-n:]
    return None, None


@pytest.mark.parametrize("max_suffix, min_count, min_share", [(5, 2, 0.5), (3, 1, 0.0), (2, 1, 0.6), (5, 3, 0.9)])
def test_rules_and_lemmas_match_a_plain_version(spark, max_suffix, min_count, min_share):
    rules = R.learn_rules(lemma_table(spark, TABLE).repartition(3), max_suffix, min_count, min_share)
    wanted = plain_rules(TABLE, max_suffix, min_count, min_share)
    assert {r["suffix"]: (r["cut"], r["added"], r["count"], r["share"]) for r in rules.collect()} == wanted
    words = ["plazas", "cruces", "bueyes", "s", "", "tabúes", "xyz", "plazas", "es", "tesis"]
    found = R.rule_lemmas(spark.createDataFrame([(w,) for w in [*words, None]], "word string"), rules, max_suffix).collect()
    assert sorted(r["word"] for r in found) == sorted(set(words))
    assert {r["word"]: (r["lemma"], r["suffix"]) for r in found} == {w: plain_lemma(w, wanted, max_suffix) for w in words}


def test_the_longest_suffix_decides(spark):
    rules = R.learn_rules(lemma_table(spark, TABLE))
    words = spark.createDataFrame([("plazas",), ("cruces",), ("bueyes",)], "word string")
    assert {r["word"]: r["lemma"] for r in R.rule_lemmas(words, rules).collect()} == {
        "plazas": "plaza", "cruces": "cruz", "bueyes": "buey",
    }


def test_repeats_nulls_ties_and_clashing_names(spark):
    rows = [("abs", "ab"), ("abs", "ab"), ("cds", "cd"), ("efs", "efz"), ("ghs", "ghz"), (None, "a"), ("as", None), ("", "x")]
    df = lemma_table(spark, rows).withColumns({"suffix": F.lit("mine"), "n": F.lit(1), "edit": F.lit(None).cast("string")})
    found = {r["suffix"]: (r["cut"], r["added"], r["count"], r["share"]) for r in R.learn_rules(df).collect()}
    assert found == {"s": (1, "", 2, 0.5)}


def test_no_lemmas_no_rules(spark):
    rules = R.learn_rules(lemma_table(spark, []))
    assert rules.count() == 0
    words = spark.createDataFrame([("casas",)], "word string")
    assert [tuple(r) for r in R.rule_lemmas(words, rules).collect()] == [("casas", None, None)]
    assert R.rule_lemmas(words.limit(0), rules).count() == 0


def test_completed_table_feeds_the_normaliser(spark):
    lemmas = lemma_table(spark, TABLE)
    docs = spark.createDataFrame([(1, "Plazas y leyes, cruces xyz")], "doc int, text string")
    surface = normalize_tokens(docs, "doc", "text", ["y"])
    full = R.complete_lemmas(lemmas, surface.select(F.explode("tokens").alias("word")), R.learn_rules(lemmas))
    assert full.groupBy("word").count().filter("count > 1").count() == 0
    assert normalize_tokens(docs, "doc", "text", ["y"], full).first()["tokens"] == ["plaza", "ley", "cruz", "xyz"]
