import random

import pytest

from hemicycle.operators.segments import headline_pairs, pair_events


def pairs_of(spark, text):
    df = spark.createDataFrame([("s", text)], "s string, t string")
    rows = headline_pairs(df, "s", "t").orderBy("pair").collect()
    return [(r["headline"], r["body"]) for r in rows]


def test_headlines_without_speech_between_merge(spark):
    text = "before *b-*FIRST ONE*-b* \n *b-*SECOND*-b* speech one here *b-*THIRD ONE*-b*"
    assert pairs_of(spark, text) == [("first one  second", "speech one here")]


def test_rejected_headline_leaves_its_text_in_the_running_body(spark):
    text = "*b-*SPEAKER*-b*body one*b-*PROYECTO DE LEY*-b*body two*b-*ABC*-b*ok.*b-*OTHER SPEAKER*-b*last body"
    assert pairs_of(spark, text) == [("speaker ok.", "body one body two"), ("other speaker", "last body")]


def fold(events):
    """Sequential form: a pair closes when a headline meets collected speech."""
    out, head, body = [], None, []
    for kind, part in events:
        if kind == "H":
            if head is not None and body:
                out.append((" ".join(head), " ".join(body)))
                head = [part]
            else:
                head = [*head, part] if head is not None else [part]
            body = []
        elif head is not None:
            (body if kind == "T" else head).append(part)
    if head is not None and body:
        out.append((" ".join(head), " ".join(body)))
    return out


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_any_chunking_agrees_with_the_sequential_fold(spark, chunk):
    rng = random.Random(chunk)
    sessions = {i: [(rng.choice("HHTTTS"), f"w{j}") for j in range(rng.randint(0, 25))] for i in range(150)}
    rows = [(s, j, kind, part) for s, events in sessions.items() for j, (kind, part) in enumerate(events)]
    df = spark.createDataFrame(rows, "s int, pos int, kind string, part string").repartition(5)
    found = {}
    for r in pair_events(df, "s", chunk).orderBy("s", "pair").collect():
        found.setdefault(r["s"], []).append((r["headline"], r["body"]))
    assert found == {s: fold(e) for s, e in sessions.items() if fold(e)}
