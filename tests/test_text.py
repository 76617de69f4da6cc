import datetime

import pytest

from hemicycle.functions import text as X
from hemicycle.operators.assembly import assemble_spans, session_records


def test_spans_are_marked_and_joined(spark):
    rows = [
        ("a", 2, 1, 1, 1, "last", "Arial"),
        ("a", 1, 1, 1, 2, "ONE", "ARIALBOLD"),
        ("a", 1, 1, 1, 1, "Two", "Arial-Bold"),
        ("a", 1, 1, 2, 1, "plain", "Arial"),
        ("a", 1, 2, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "doc string, page int, block int, line int, span int, text string, font string")
    text = assemble_spans(df).first()["raw_text"]
    assert text == "*b-*Two*-b* *b-*ONE*-b* \nplain \n\n\nlast \n\n"


@pytest.mark.parametrize(
    "line, kept",
    [("ABC DEF", ""), ("*b-*ABC*-b*", "*b-*ABC*-b*"), ("ÁÑ ñ", ""), ("Abc", "Abc"), ("A\x85bc", "bc")],
)
def test_line_filter(one, line, kept):
    assert one(X.keep_mixed_case_lines, line) == kept


def test_boilerplate_is_bound_to_its_line(one):
    text = "imprenta nacional de colombia - x\nwww.imprenta.gov.co y PÁGINA 12\nEdición de 8 páginas z\naño II Nº 4\nrest"
    assert one(X.drop_boilerplate, text) == "\n y \n z\n\nrest"


def test_hyphen_blank_lines_and_bold_runs(one):
    assert one(X.join_hyphenated, "pala- \nbra") == "palabra"
    assert one(X.collapse_blank_lines, " a\n  \n\nb\n ") == "a\nb"
    assert one(X.merge_bold_lines, "*b-*A*-b* \n *b-*B*-b*") == "*b-*A B*-b*"
    assert one(X.isolate_bold_markers, "*b-*A*-b*") == "\n*b-*\nA\n*-b*\n"


def test_act_heading_is_cut_and_five_characters_go_in_any_case(one):
    assert one(X.cut_before_act, "x\nACTA NÚMERO 3 DE 2016abcdefg ACTA NÚMERO 4 DE 2016") == "fg ACTA NÚMERO 4 DE 2016"
    assert one(X.cut_before_act, "abcdefg") == "fg"


def test_clean_keeps_newlines_on_request(one):
    text = "abcde uno\n\nDOS\ntres"
    assert one(X.clean_raw_text, text) == "uno tres"
    assert one(lambda t: X.clean_raw_text(t, keep_newlines=True), text) == "uno\ntres"


@pytest.mark.parametrize(
    "text, date",
    [
        ("a 3 de mayo de 2016 y 4 de mayo de 2017", datetime.date(2016, 5, 3)),
        ("12  DE\nDiciembre de 1999", datetime.date(1999, 12, 12)),
        ("none", None),
        ("31 de febrero de 2016", None),
    ],
)
def test_session_date(one, text, date):
    assert one(X.session_date, text) == date


def test_chamber_and_type(one):
    assert one(X.session_chamber, "c á m a r a de\nrepresentantes") == "house"
    assert one(X.session_chamber, "x" * 1000 + "cámara de representantes") == "senate"
    assert one(X.session_type, "comisión") == one(X.session_type, "Comision") == "commitee"
    assert one(X.session_type, "sesión") == "plenary"


@pytest.mark.parametrize("headline, ok", [("abcde", False), ("abcdef", True), ("el proyecto de ley", False)])
def test_headline_test(one, headline, ok):
    assert one(X.is_headline, headline) is ok


def test_bold_split_keeps_unmatched_markers(one):
    assert one(X.split_bold, "a*b-*x*b-*y*-b*b*-b*c*b-*d") == ["a", "*b-*x*b-*y*-b*", "b*-b*c*b-*d"]


def test_session_record(spark):
    raw = (
        "*b-*ACTA NÚMERO 1 DE 2016*-b* \nCámara de Representantes, 3 de mayo de 2016 \n"
        "*b-*EL PRESIDENTE*-b* \nabre la sesión ordinaria \n*b-*EL SECRETARIO*-b* \nlee el informe \n"
    )
    df = spark.createDataFrame([("g1", raw), ("g2", "nothing here at all")], "doc string, raw_text string")
    rows = {r["session_id"]: r for r in session_records(df).collect()}
    record = rows["g1"]
    assert (record["date"], record["chamber"], record["type"]) == (datetime.date(2016, 5, 3), "house", "plenary")
    assert [tuple(p) for p in record["pairs"]] == [
        ("el presidente", "abre la sesión ordinaria"),
        ("el secretario", "lee el informe"),
    ]
    assert record["keywords"] == [["abre", "ordinaria", "sesión"], ["informe", "lee"]]
    assert rows["g2"]["pairs"] == [] and rows["g2"]["keywords"] == []
