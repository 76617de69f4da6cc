import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from hemicycle.llm import anchors, intervals, repeats

from .conftest import ODD, make

SF = "/root/testdata/sf0.001/documents.parquet"


def plain_words(docs):
    """``(doc_id, n_words, n_removed, sha)`` by counting every window of 35 words."""
    texts = [(i, (t or "").encode().split()) for i, t in docs]
    seen = Counter(tuple(w[k : k + 35]) for _, w in texts for k in range(len(w) - 34))
    out = []
    for i, w in texts:
        gone = set()
        for k in range(len(w) - 34):
            if seen[tuple(w[k : k + 35])] > 1:
                gone.update(range(k, k + 35))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def plain_bytes(docs):
    texts = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(hash(b[k : k + 400]) for _, b in texts for k in range(len(b) - 399))
    out = []
    for i, b in texts:
        gone = np.zeros(len(b) + 1, dtype=bool)
        for k in range(len(b) - 399):
            if seen[hash(b[k : k + 400])] > 1:
                gone[k : k + 400] = True
        runs = int(np.count_nonzero(gone[:-1] & ~np.concatenate([[False], gone[:-2]]))) if b else 0
        kept = np.frombuffer(b, dtype=np.uint8)[~gone[:-1]].tobytes()
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def sha(rows):
    return sorted([(*r[:-1], hashlib.sha256(r[-1]).hexdigest()) for r in map(tuple, rows)], key=repr)


def shared_passages():
    """Texts that share passages of many lengths at many places, loops, and near copies."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 9)))
    passages = [[word() for _ in range(n)] for n in (34, 35, 36, 60, 120, 300)]
    docs = []
    for k in range(120):
        words = [word() for _ in range(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 3)):
            words += rng.choice(passages) + [word() for _ in range(rng.randint(0, 30))]
        docs.append((k, "  ".join(words) if k % 3 else "\n".join(words), "a"))
    common = " ".join(passages[4])
    docs += [(1000 + k, f"{word()} {common} {word()} {word()}", "hot") for k in range(60)]
    docs += [(2000, "la " * 500, "a"), (2001, "x" * 2000, "a"), (2002, "xy" * 700, "a"), (2003, "la " * 36, "a")]
    copy = docs[5][1].split() * 3
    docs += [(3000 + k, " ".join(copy[:k] + ["edit"] + copy[k:]), "b") for k in range(0, 100, 20)]
    return docs


CASES = {"given": None, "odd": ODD, "passages": shared_passages()}


@pytest.fixture(params=list(CASES))
def case(request, spark):
    docs = CASES[request.param]
    if docs is None:
        table = spark.read.parquet(SF)
        return table, [(r.doc_id, r.text) for r in table.collect()]
    return make(spark, docs, ("spans", "start", "anchor", "kept")).repartition(3), [(i, t) for i, t, _ in docs]


@pytest.mark.parametrize("hot", [False, True])
def test_repeated_words_go(case, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(anchors, "HOT_ROWS", 3)
        monkeypatch.setattr(anchors, "SAMPLE", 2)
    table, docs = case
    assert sha(repeats.remove_repeated_words(table).collect()) == plain_words(docs)


@pytest.mark.parametrize("mode", ["arrays", "hot", "named"])
def test_repeated_bytes_go(case, monkeypatch, mode):
    if mode == "hot":
        monkeypatch.setattr(anchors, "HOT_ROWS", 3)
        monkeypatch.setattr(anchors, "SAMPLE", 2)
    if mode == "named":
        monkeypatch.setattr(repeats, "ARRAY_BYTES", 1500)
    table, docs = case
    assert sha(repeats.remove_repeated_bytes(table).collect()) == plain_bytes(docs)


def test_nothing_to_remove(nothing):
    assert repeats.remove_repeated_words(nothing).count() == 0
    assert repeats.remove_repeated_bytes(nothing).count() == 0


def test_common_prefixes_are_those_of_sorted_suffixes():
    rng = np.random.default_rng(2)
    for n, least in ((1, 3), (40, 3), (300, 8), (300, 20)):
        text = np.concatenate([rng.integers(1, 3, n), [0]]).astype(np.int16)
        order = intervals.suffix_order(text, least)
        got = intervals.common_prefixes(text, order, least)
        suffixes = [text[i:].tolist() for i in order]
        for k in range(1, len(order)):
            a, b = suffixes[k - 1], suffixes[k]
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert got[k] == (same if same < least else -1)


def test_repeated_starts():
    rng = random.Random(4)
    parts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 60))) for _ in range(20)] + [b"", b"aaaaaaaaaaaaaaaaaaaa"]
    seen = Counter(p[k : k + 12] for p in parts for k in range(len(p) - 11))
    want = [[k for k in range(len(p) - 11) if seen[p[k : k + 12]] > 1] for p in parts]
    assert [f.tolist() for f in intervals.repeated_starts(parts, 12)] == want


def test_equal_spans_meet_however_texts_are_grouped():
    texts = [t.encode() for _, t, _ in shared_passages()]
    whole = anchors.spans(texts, repeats.WORDS)
    single = [anchors.spans([t], repeats.WORDS) for t in texts]
    for column in range(1, 5):
        assert np.array_equal(whole[column], np.concatenate([s[column] for s in single]))


def near_copies(n):
    """Copies of one text, each with a word of its own at a place of its own, and with one of some passages behind."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    common, tails = [word() for _ in range(140)], [[word() for _ in range(60)] for _ in range(5)]
    docs = []
    for k in range(n):
        at = rng.randrange(len(common))
        docs.append((k, " ".join([*common[:at], f"{word()}{k}", *common[at:], *rng.choice(tails)]), "a"))
    return docs


def test_a_large_anchor_gives_stretches_not_windows(monkeypatch):
    """Spans of one anchor, more than an array holds: a few rows per span, whatever the size of the group."""
    docs = near_copies(300)
    texts = [t.encode() for _, t, _ in docs]
    text, start, more, anchor, _ = anchors.spans(texts, repeats.BYTES)
    most = Counter(anchor.tolist()).most_common(1)[0][0]
    group = [k for k in range(len(text)) if anchor[k] == most]
    rows = pa.table({
        "anchor": pa.array([1] * len(group), pa.int64()), "doc_id": pa.array([int(text[k]) for k in group]),
        "text_hash": pa.array([0] * len(group), pa.int64()), "start": pa.array([int(start[k]) for k in group], pa.int32()),
        "data": pa.array([texts[text[k]][start[k] : start[k] + more[k] + 400] for k in group], pa.binary()),
    })
    monkeypatch.setattr(repeats, "ARRAY_BYTES", 20_000)
    assert rows.column("data").nbytes > 4 * repeats.ARRAY_BYTES
    found = [r for b in repeats._expand(iter(rows.to_batches())) for r in b.to_pylist()]
    assert all(r["done"] for r in found) and len(found) < 4 * len(group)
    windows = lambda k: range(int(start[k]), int(start[k] + more[k]) + 1)
    seen = Counter(texts[text[k]][w : w + 400] for k in group for w in windows(k))
    want = {(int(text[k]), w) for k in group for w in windows(k) if seen[texts[text[k]][w : w + 400]] > 1}
    assert {(r["doc_id"], w) for r in found for w in range(r["start"], r["start"] + r["more"] + 1)} == want
    assert want and len(want) < sum(len(windows(k)) for k in group)


@pytest.mark.parametrize("group_bytes", [1 << 24, 3000])
def test_large_anchors_are_exact(spark, monkeypatch, group_bytes):
    monkeypatch.setattr(repeats, "ARRAY_BYTES", 1500)
    monkeypatch.setattr(repeats, "GROUP_BYTES", group_bytes)
    docs = near_copies(80) + [(1000 + k, t, s) for k, t, s in shared_passages()]
    got = repeats.remove_repeated_bytes(make(spark, docs).repartition(3)).collect()
    assert sha(got) == plain_bytes([(k, t) for k, t, _ in docs])
