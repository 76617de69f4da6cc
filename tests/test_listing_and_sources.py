from pyspark.sql import functions as F

from hemicycle.operators import interventions, listing
from hemicycle.operators.explore import not_landed
from hemicycle.sources import readers, writers

ROWS = "page int, pos int, raw_id string, date string, chamber string"


def test_rows_without_a_field_are_skipped(spark):
    html = "<tr><i>12</i><b>Senado</b></tr><tr><i></i><b>x</b></tr><tr><i>13</i></tr><tr><i>14</i><b>Cámara</b></tr>"
    pages = spark.createDataFrame([(1, html)], "page int, html string")
    rows = listing.listing_rows(pages, "page", "html", "(<tr>.*?</tr>)", {"raw_id": "<i>(.*?)</i>", "chamber": "<b>(.*?)</b>"})
    assert [(r["pos"], r["raw_id"], r["chamber"]) for r in rows.orderBy("pos").collect()] == [
        (0, "12", "Senado"),
        (3, "14", "Cámara"),
    ]


def test_repeated_ids_get_a_number(spark):
    df = spark.createDataFrame([(1, i, "7", "d", "c") for i in range(3)] + [(1, 3, "7 (1)", "d", "c")], ROWS)
    ids = [r["session_id"] for r in listing.unique_ids(df, "page", "pos", "raw_id").orderBy("pos").collect()]
    assert ids == ["gaceta_7", "gaceta_7 (1)", "gaceta_7 (2)", "gaceta_7 (1) (1)"]


def test_later_page_wins(spark):
    df = spark.createDataFrame([(2, 0, "7", "new", "Cámara X"), (1, 0, "7", "old", "Senado"), (1, 1, "8", "d", "Senado")], ROWS)
    rows = sorted(tuple(r) for r in listing.session_info(df, "page", "pos").collect())
    assert rows == [("gaceta_7", "new", "house"), ("gaceta_8", "d", "senate")]


def test_csv_with_line_breaks_quotes_and_nulls(spark, tmp_path):
    rows = [("g1", "2016", "senate", "plenary", 'raw\n"text"', "a,b", None, "[['a', 'b'], ['c']]")]
    df = spark.createDataFrame(rows, readers.schemas.SESSION_TEXT)
    path = str(tmp_path / "sessions")
    assert writers.write_csv(df, path) == 1
    back = readers.read_session_csv(spark, path)
    assert [tuple(r) for r in back.collect()] == rows
    exploded = interventions.explode_legacy(back)
    assert [r["intervention"] for r in exploded.collect()] == ["['a', 'b'", "'c']"]


def test_documents_are_named_after_their_files(spark, tmp_path):
    (tmp_path / "gaceta_1.txt").write_text("uno\ndos")
    (tmp_path / "gaceta_22.txt").write_text("tres")
    docs = {r["doc"]: r["raw_text"] for r in readers.read_documents(spark, str(tmp_path)).collect()}
    assert docs == {"gaceta_1": "uno\ndos", "gaceta_22": "tres"}
    assert {r["doc"]: r["bytes"] for r in readers.list_documents(spark, str(tmp_path)).collect()} == {"gaceta_1": 7, "gaceta_22": 4}


def test_rejects_name_every_failed_check(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "id int, t string")
    ok, bad = readers.split_rejects(df, {"missing": F.col("t").isNull(), "empty": F.length("t") == 0})
    assert [r["id"] for r in ok.collect()] == [1]
    assert {r["id"]: r["problems"] for r in bad.collect()} == {2: ["missing"], 3: ["empty"]}


def test_ids_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(f"s{i}", [f"t{i}-{j}" for j in range(i)]) for i in range(8)], "id string, interventions array<string>")
    runs = [
        sorted(tuple(r) for r in interventions.explode_interventions(df.repartition(n)).collect()) for n in (1, 4, 50)
    ]
    assert runs[0] == runs[1] == runs[2]
    assert len({r[1] for r in runs[0]}) == sum(range(8))
    native = interventions.explode_interventions(df, stable_id=False)
    assert native.select("int_id").distinct().count() == sum(range(8))


def test_anti_join(spark):
    listed = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    landed = spark.createDataFrame([(2, "x")], "id int, t string")
    assert sorted(r["id"] for r in not_landed(listed, landed, "id").collect()) == [1, 3]
