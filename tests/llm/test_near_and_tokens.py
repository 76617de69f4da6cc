import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from hemicycle.llm import components, fingerprints, packing, tokencounts

from .conftest import ODD, make

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SF = "/root/testdata/sf0.001/documents.parquet"


def plain_print(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest id reachable for ``(doc_id, print)`` by all pairs."""
    values = sorted({p for _, p in prints})
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = defaultdict(list)
    for d, p in prints:
        least[find(p)].append(d)
    return [(d, p, min((x for x in least[find(p)] if x is not None), default=None)) for d, p in prints]


def key(rows):
    return sorted(rows, key=repr)


def test_fingerprints_and_components_of_odd_documents(clashing):
    got = fingerprints.near_duplicates(clashing).collect()
    want = plain_components([(i, plain_print(t)) for i, t, _ in ODD])
    assert key([tuple(r) for r in got]) == key([(d, f"{p:016x}", c) for d, p, c in want])


def test_fingerprints_of_the_documents(spark):
    docs = spark.read.parquet(SF)
    got = key([tuple(r) for r in fingerprints.near_duplicates(docs).collect()])
    prints = [(r.doc_id, plain_print(r.text)) for r in docs.collect()]
    assert got == key([(d, f"{p:016x}", c) for d, p, c in plain_components(prints)])


@pytest.mark.parametrize("short", [0, 2, 32])
def test_links_connect_as_all_pairs_do(spark, monkeypatch, short):
    monkeypatch.setattr(fingerprints, "SHORT_LIST", short)
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(6)]
    values = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 4))) for b in base for _ in range(60)}
    values |= {0, 1, 1 << 63, (1 << 64) - 1, 3 << 62}
    rows = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    prints = spark.createDataFrame(rows, "print long")
    got = {(r.node, r.root) for r in components.components(fingerprints.links(prints)).collect()}
    want = plain_components([(v[0], v[0] & (1 << 64) - 1) for v in rows])
    linked = {r[0] for r in want if sum(w[2] == r[2] for w in want) > 1}
    assert got == {(d, c) for d, _, c in want if d in linked}


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (100, 101), (None, 3)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_document_of_each_component_stays(spark, clashing, nothing):
    kept = fingerprints.drop_near_duplicates(clashing)
    assert kept.columns == clashing.columns
    want = plain_components([(i, plain_print(t)) for i, t, _ in ODD])
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in want})
    assert fingerprints.drop_near_duplicates(nothing).count() == 0
    assert fingerprints.near_duplicates(nothing).count() == 0


def ids_of(texts, special_as_text=True):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = special_as_text
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check_pieces(rows, docs, size):
    """Every id lies in one piece, sequences are gapless and no longer than ``size``."""
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(list)
    for (i, _, _), ids in zip(docs, ids_of([t for _, t, _ in docs]), strict=True):
        want[i].append([*ids, 1])
    for i, texts in want.items():
        assert len(set(map(tuple, texts))) == 1 or i is None
        if len(texts) > 1:
            assert sum(r.length for r in pieces[i]) == sum(map(len, texts))
            continue
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            part = np.array(texts[0][r.start : r.start + r.length], dtype="<u4")
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(texts[0]), zlib.crc32(part.tobytes()))
            at += r.length
        assert at == len(texts[0])
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= size
    return [sum(n for _, n in parts) for parts in sequences.values()]


def test_packing_holds_every_token_once(clashing, nothing):
    rows = packing.pack(clashing.repartition(4), RANKS).collect()
    lengths = check_pieces(rows, ODD, packing.SIZE)
    assert sum(1 for n in lengths if n < packing.SIZE - packing.LEAST_CUT) <= 1
    assert packing.pack(nothing, RANKS).count() == 0


def test_packing_of_the_documents(spark):
    docs = spark.read.parquet(SF)
    rows = packing.pack(docs.repartition(7), RANKS, with_ids=True).collect()
    given = [(r.doc_id, r.text, None) for r in docs.collect()]
    lengths = check_pieces(rows, given, packing.SIZE)
    assert sum(lengths) >= 0.97 * len(lengths) * packing.SIZE
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in rows)


def test_token_counts(clashing, nothing, monkeypatch):
    monkeypatch.setattr(tokencounts, "BLOCK", 64)
    monkeypatch.setattr(tokencounts, "STRETCH", 3)
    got = [tuple(r) for r in tokencounts.token_counts(clashing.repartition(3), RANKS).collect()]
    assert key(got) == key([(i, len(t)) for (i, _, _), t in zip(ODD, ids_of([t for _, t, _ in ODD]), strict=True)])
    assert tokencounts.token_counts(nothing, RANKS).count() == 0


@pytest.mark.parametrize("stretch", [1, 2, 1000])
def test_separator_scan_of_random_files(spark, monkeypatch, stretch):
    monkeypatch.setattr(tokencounts, "STRETCH", stretch)
    rng = np.random.default_rng(3)
    rows, want = [], []
    for file, n in enumerate([0, 1, 5, 64, 200, 333]):
        ids = rng.integers(0, 3, n).astype("<u2")
        ids[rng.random(n) < [0, 1, 0.5, 0.02, 0.1, 0.005][file]] = 50256
        at = [-1, *np.flatnonzero(ids == 50256).tolist()]
        want += [(file, k, b - a - 1, True) for k, (a, b) in enumerate(zip(at, at[1:]))]
        if n - at[-1] > 1:
            want.append((file, len(at) - 1, n - at[-1] - 1, False))
        rows += [(file, k, ids[b : b + 8].tobytes()) for k, b in enumerate(range(0, n, 8))]
    blocks = spark.createDataFrame(rows, "file long, block long, ids binary")
    assert sorted(map(tuple, tokencounts.separator_scan(blocks).collect())) == sorted(want)


def test_flat_files_are_read_in_blocks(spark, tmp_path):
    ids = np.arange(1000, dtype="<u2")
    ids[[0, 10, 500, 999]] = 50256
    (tmp_path / "a.bin").write_bytes(ids.tobytes())
    (tmp_path / "empty.bin").write_bytes(b"")
    blocks = tokencounts.read_token_files(spark, str(tmp_path), block=64)
    got = tokencounts.separator_scan(blocks).orderBy("position").select("n_tokens", "closed").collect()
    assert [tuple(r) for r in got] == [(0, True), (9, True), (489, True), (498, True)]


STRANGE = ["a<|endoftext|>b", "<|endoftext|>", "<|endoftext|><|endoftext|> x", " <|endoftext|>\n", "<|endoftext", "<|ENDOFTEXT|>",
           "\u00a0\u2003x  y\t\tz \r\n", "\U0001f600\U0001f468\u200d\U0001f469 e\u0301 \u0000 \ufeff", "", None,
           "'s 'S it'll 12345 \u0661\u0662"]


def test_packed_ids_are_those_of_the_vocabulary_file(spark):
    """Added tokens, odd white space and emoji: the ids that ``tokenizers`` gives with the file as it is."""
    rows = make(spark, [(k, t, "a") for k, t in enumerate(STRANGE)])
    got = packing.pack(rows, RANKS, size=64, with_ids=True).collect()
    for k, ids in enumerate(ids_of(STRANGE, special_as_text=False)):
        pieces = sorted((r.start, np.frombuffer(r.ids, dtype="<u4").tolist()) for r in got if r.doc_id == k)
        assert [i for _, p in pieces for i in p] == [*ids, 1]
    assert 50256 in ids_of(STRANGE[:1], special_as_text=False)[0]
