from pyspark.sql import functions as F

from hemicycle.functions import literals, vectors
from hemicycle.functions import tokens as N
from hemicycle.operators.normalize import normalize_tokens


def test_tokenizer_splits_on_each_ascii_space(spark):
    df = spark.createDataFrame([(1, "Sol  dos\u00a0tres el")], "id int, t string")
    row = N.basket_pipeline("t").fit(df).transform(df).first()
    assert row["tokens"] == ["sol", "", "dos\u00a0tres", "el"]
    assert row["filtered_tokens"] == ["sol", "", "dos\u00a0tres"]


def test_stop_words_leave_repetitions(spark):
    df = spark.createDataFrame([(["a", "b", "a", "b", "c"],)], "w array<string>")
    assert df.select(N.without_words(F.col("w"), ["a"])).first()[0] == ["b", "b", "c"]


def test_valid_and_distinct_tokens(spark):
    df = spark.createDataFrame([(["año", "x1", "año", ""],), (None,)], "w array<string>")
    rows = [r[0] for r in df.select(N.distinct_in_order(N.valid_words(F.col("w")))).collect()]
    assert rows == [["año"], []]


def test_words_terms_and_sentences(one):
    assert one(N.word_tokens, "¡Hola, año-2020! x") == ["Hola", "año", "2020", "x"]
    assert one(N.terms, "A bc_1 d Éa") == ["bc_1", "éa"]
    assert one(N.sentences, "Uno dos.  ¿Tres? Cuatro 3.5!\nfin ") == ["Uno dos.", "¿Tres?", "Cuatro 3.5!", "fin"]


def test_term_counts(one):
    rows = one(N.term_counts, "bb aa bb cc aa bb d")
    assert [(r["term"], r["tf"]) for r in rows] == [("aa", 2), ("bb", 3), ("cc", 1)]
    assert one(N.term_counts, "") == []


def test_normalisation_with_lemmas(spark):
    df = spark.createDataFrame(
        [(1, ["Los perros", "3 dos ladran perros"]), (2, ["los"])], "id int, t array<string>"
    )
    lemmas = spark.createDataFrame([("perros", "perro")], "word string, lemma string")
    rows = {r["id"]: r["tokens"] for r in normalize_tokens(df, "id", "t", ["los"], lemmas).collect()}
    assert rows == {1: ["perro", "ladran", "perro"], 2: []}
    plain = normalize_tokens(df, "id", "t", ["los"], extra_stop=["ladran"]).collect()
    assert {r["id"]: r["tokens"] for r in plain}[1] == ["perros", "perros"]


def test_vector_literals(one):
    assert one(vectors.parse_vector, "[1.0, -2e-3]") == [1.0, -0.002]
    assert one(vectors.parse_vector, "[1.0  2.0\n 3.]") == [1.0, 2.0, 3.0]
    assert one(vectors.parse_vector, "bad") is None
    assert one(vectors.parse_vector, None) is None
    assert one(vectors.parse_json_vector, "[1, 2.5]") == [1.0, 2.5]
    assert one(vectors.parse_json_vector, "[1, x]") is None
    assert one(vectors.find_floats, "x -.5 y 2.25 3") == [-0.5, 2.25]


def test_list_literals(one):
    assert one(literals.split_nested_list, "[['a', 'b'], ['c']]") == ["['a', 'b'", "'c']"]
    assert one(literals.parse_words, """['a', "it's", 'b\\'c']""") == ["a", "it's", "b'c"]
    assert one(literals.parse_nested_words, "[['a', 'b'], ['c']]") == [["a", "b"], ["c"]]
    assert one(literals.label_from_name, "cluster_7_n2v.model") == 7


def test_words_literal_round_trip(spark):
    words = ["a", "it's", "back\\slash", "ñ"]
    df = spark.createDataFrame([(words,)], "w array<string>")
    text = df.select(literals.words_literal(F.col("w")).alias("t"))
    assert text.select(literals.parse_words(F.col("t"))).first()[0] == words


def test_lemmas_keep_every_row_and_its_order(spark):
    """Rows of one id stay apart; null texts, null ids and texts without a lemma too."""
    texts = [(1, "perros ven perros"), (1, "gatos ven"), (None, "gatos"), (2, None), (3, "")]
    df = spark.createDataFrame(texts, "id int, t string")
    lemmas = spark.createDataFrame([("perros", "perro"), ("gatos", "gato")], "word string, lemma string")
    rows = normalize_tokens(df, "id", "t", [], lemmas).collect()
    found = sorted((str(r["id"]), r["tokens"]) for r in rows)
    assert found == [("1", ["gato", "ven"]), ("1", ["perro", "ven", "perro"]), ("2", []), ("3", []), ("None", ["gato"])]
