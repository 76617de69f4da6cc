import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from hemicycle.llm import codes, lines, runs

from .conftest import LONG, ODD, make


def plain_runs(words):
    """All stretches that repeat with a period, by comparing every word with the one a period on."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        x = 0
        while x < n - q:
            if words[x] != words[x + q]:
                x += 1
                continue
            y = x
            while y < n - q and words[y] == words[y + q]:
                y += 1
            if y - x + q >= max(6, 4 * q):
                found.setdefault((x, y - x + q), q)
            x = y
    return sorted(((s, n_, q) for (s, n_), q in found.items()), key=lambda r: (r[0], r[2]))


def test_grammar_and_runs_of_random_words():
    rng = random.Random(5)
    for _ in range(600):
        n, k = rng.randint(0, 90), rng.choice([1, 2, 2, 3, 6])
        words = [rng.randrange(k) for _ in range(n)]
        if n and rng.random() < 0.6:
            a, p = rng.randrange(n), rng.randint(1, 12)
            words = [words[i] if i < a else words[a + (i - a) % p] if a + (i - a) % p < n else words[i] for i in range(n)]
        numbers = np.array(words, dtype=np.int64)
        grammar = runs.Grammar(numbers)
        for _ in range(4 if n > 1 else 0):
            i, j = sorted(rng.sample(range(n), 2))
            same = next((t for t in range(n - j) if words[i + t] != words[j + t]), n - j)
            assert grammar.common(i, j) == same
        assert [tuple(r) for r in runs.periodic_runs(numbers)] == plain_runs(words)


def test_grid_in_small_stretches(monkeypatch):
    monkeypatch.setattr(runs, "GRID", 64)
    words = np.array([k % 7 for k in range(100)] + [0] * 60 + [k % 3 for k in range(50)], dtype=np.int64)
    assert [tuple(r) for r in runs.periodic_runs(words)] == plain_runs(words.tolist())


@pytest.fixture(scope="module")
def looped(spark):
    rows = [*ODD, (20, "x " * 9, "a"), (21, "a b " * 5 + "c " * 7 + "a b", "a"), (22, "Tick tock tick Tock " * 3, "a")]
    return rows, make(spark, rows, ("runs", "n_words", "collapsed", "best"))


def test_runs_of_odd_documents(looped, nothing):
    rows, docs = looped
    got = runs.document_runs(docs).collect()
    want = []
    for i, t, _ in rows:
        words = (t or "").encode().split()
        if t == LONG:
            found = [(r.start, r.length, r.period) for r in runs.periodic_runs(runs.numbered(words))]
            assert found == []
        else:
            found = plain_runs(words)
        gone = {x for s, n, q in found for x in range(s + q, s + n)}
        want.append((i, len(words), tuple(found), b" ".join(w for k, w in enumerate(words) if k not in gone)))
    have = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), bytes(r.collapsed)) for r in got)
    assert have == Counter(want)
    digest = {r.doc_id: r for r in runs.digests(runs.document_runs(docs)).collect()}
    assert (digest[20].start, digest[20].length, digest[20].period, digest[20].exponent_milli) == (0, 9, 1, 9000)
    assert digest[1].n_runs == 0 and digest[1].start is None and digest[1].runs_sha256 is not None
    assert runs.document_runs(nothing).count() == 0


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType()), T.StructField("at", T.StringType()),
                        T.StructField("error", T.StringType())])


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, c, "x", "y") for i, v, c in rows], VECTORS)


def plain_codes(rows, entries, parts=4, rounds=4):
    """All distances in every round, on Python's whole numbers."""
    kept = [(i, [int(np.floor(np.float64(np.float32(x)) * 1024)) for x in v], c) for i, v, c in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = -(-max([len(v) for _, v, _ in kept], default=1) // parts)
    kept = [(i, v + [0] * (parts * width - len(v)), c) for i, v, c in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    out = [([], 0) for _ in kept]
    books = []
    for p in range(parts):
        cut = [v[p * width : (p + 1) * width] for _, v, _ in kept]
        book = [v[p * width : (p + 1) * width] for _, v, _ in first]
        for n in range(rounds + 1):
            near = [min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book)) for x in cut]
            if n < rounds:
                for k in range(len(book)):
                    own = [x for x, (_, at) in zip(cut, near) if at == k]
                    if own:
                        book[k] = [sum(col) // len(own) for col in zip(*own)]
        out = [(at + [k], error + d) for (at, error), (d, k) in zip(out, near)]
        books.append(book)
    return Counter((i, str(c) if c is not None else None, bytes(at), e) for (i, _, c), (at, e) in zip(kept, out)), books


def random_vectors(n, dim, spread, seed):
    rng = np.random.default_rng(seed)
    values = np.round(rng.normal(0, spread, (n, dim)) * 8) / 8 if seed % 2 else rng.normal(0, spread, (n, dim))
    return [(int(k), [float(np.float32(x)) for x in v], int(k % 3) if k % 5 else None) for k, v in enumerate(values)]


@pytest.mark.parametrize(("n", "dim", "entries", "bounds", "seed"), [(120, 8, 16, 4, 1), (90, 8, 16, 1, 2), (60, 4, 60, 16, 3), (5, 8, 16, 16, 4), (80, 8, 12, 0, 5)])
def test_codes_against_all_distances(spark, n, dim, entries, bounds, seed):
    rows = random_vectors(n, dim, 1.0, seed)
    found, books = codes.vector_codes(vectors(spark, rows).repartition(3), entries=entries, bounds=bounds)
    want, plain = plain_codes(rows, entries)
    assert Counter((r.vec_id, r.label, bytes(r["at"]), r.error) for r in found.collect()) == want
    assert books.tolist() == plain


def test_codes_of_odd_vectors(spark):
    bad = [(1, None, 0), (2, [1.0, None, 0.0, 0.0], 0), (3, [float("nan"), 0.0, 0.0, 0.0], 1), (4, [float("inf"), 0.0, 0.0, 0.0], 1)]
    good = [(5, [], 0), (6, [0.5, -0.5, 0.25], None), (7, [1.0, 2.0, 3.0, 4.0, 5.0], 2), (7, [1.0, 2.0, 3.0, 4.0, 5.0], 2), (None, [0.0], None)]
    found, books = codes.vector_codes(vectors(spark, bad + good), entries=4)
    want, plain = plain_codes(bad + good, 4)
    assert Counter((r.vec_id, r.label, bytes(r["at"]), r.error) for r in found.collect()) == want and books.tolist() == plain
    rows = codes.code_table(found, books).collect()
    errors = defaultdict(int)
    for (_, c, _, e), k in want.items():
        errors[c] += e * k
    assert sorted(r.label_error for r in rows) == sorted(errors[c] for (_, c, _, _), k in want.items() for _ in range(k))
    huge, _ = codes.vector_codes(vectors(spark, [(1, [3e38, 0.0, 0.0, 0.0], 0), (2, [-3e38, 1.0, 0.0, 0.0], 0)]), entries=1)
    assert all(r.error >= 0 for r in huge.collect())
    for nothing in (vectors(spark, []), vectors(spark, bad)):
        found, books = codes.vector_codes(nothing)
        assert codes.code_table(found, books).count() == 0 and books.size == 0


def plain_lines(rows, least=5):
    holders = defaultdict(list)
    keys = lambda t: [x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)}) for x in (t or "").split("\n")]
    for r, (_, t, _) in enumerate(rows):
        for k in {k for k in keys(t) if len(k) >= 40}:
            holders[k].append(r)
    keeper = {k: max((rows[r][0] for r in rs if rows[r][0] is not None), default=None) for k, rs in holders.items() if len(rs) >= least}
    out = Counter()
    for i, t, _ in rows:
        all_ = (t or "").split("\n")
        kept = [x for x, k in zip(all_, keys(t)) if k not in keeper or keeper[k] == i]
        out[i, len(all_), len(all_) - len(kept), "\n".join(kept).encode()] += 1
    return out


def line_rows(seed):
    rng = random.Random(seed)
    common = [f"Line {k} that many sites share, été and long enough" + "." * k for k in range(6)] + ["é" * 39, "é" * 40, "short", ""]
    rows = []
    for i in range(120):
        own = [f"own line number {i} of one document only, {rng.random()}" for _ in range(rng.randint(0, 3))]
        text = own + [rng.choice(common) for _ in range(rng.randint(0, 4))] + [f"Pair {i // 4} of four documents, so it stays {'x' * 20}"]
        rng.shuffle(text)
        rows.append((i if i % 17 else None, "\n".join(x.upper() if rng.random() < 0.2 else f" \t{x}\r" for x in text), "a"))
    hot = "A line that a third of all the rows hold, word for word"
    return rows + [(500 + k // 2, hot + "\n" + hot + "\nend", "hot") for k in range(60)] + ODD * 2


@pytest.mark.parametrize("sent", [lines.SENT_WORDS, 0])
@pytest.mark.parametrize("words", [None, 1])
def test_common_lines_against_counts(spark, monkeypatch, sent, words):
    """Filters sent or joined; with filters so small that nearly every line is suspected, too."""
    if words:
        monkeypatch.setattr(lines, "BYTES_A_WORD", 1 << 40)
        monkeypatch.setattr(lines, "FLUSH", 7)
        monkeypatch.setattr(lines, "HOT_ROWS", 20)
    rows = line_rows(1)
    docs = make(spark, rows, ("key", "lines", "word", "bits", "spans", "n")).repartition(5)
    got = lines.drop_common_lines(docs, sent_words=sent).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, bytes(r.kept)) for r in got) == plain_lines(rows)


def test_filters_hold_what_is_seen_twice(spark):
    """Every key of two documents is suspected; of keys seen once only a few are."""
    rows = [(k, f"{'shared' if k % 2 else 'single'} line {k // 2 % 40 if k % 2 else k} {'padding ' * 5}", "a") for k in range(4000)]
    texts = lines.keyed(make(spark, rows).repartition(6), "doc_id", "text")
    found = [bytes(r.key) for r in lines.suspected_lines(texts, 1 << 10).collect()]
    assert sum(k.startswith(b"shared") for k in found) == 2000
    assert sum(k.startswith(b"single") for k in found) < 200


@pytest.mark.parametrize("sent", [lines.SENT_WORDS, 0])
def test_common_lines_of_nothing(nothing, sent):
    assert lines.drop_common_lines(nothing, sent_words=sent).count() == 0
