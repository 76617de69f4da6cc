"""Operators made of DataFrame functions, against plain versions on odd documents."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hemicycle.llm import contentsort, hostrules, mixing, slots

from .conftest import ODD, make

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def key(rows):
    return sorted(rows, key=repr)


def plain_exact(rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    out = []
    for content, members in groups.items():
        members.sort()
        sha = hashlib.sha256(content.encode()).hexdigest()
        out += [(m[3], members[0][3], len(members), k == 0, sha) for k, m in enumerate(members)]
    return key(out)


@pytest.mark.parametrize("run_rows", [1, 2, 10_000])
def test_exact_duplicates(clashing, nothing, run_rows):
    got = contentsort.exact_duplicates(clashing, run_rows=run_rows)
    assert key(tuple(r) for r in got.collect()) == plain_exact(ODD)
    kept = contentsort.drop_exact_duplicates(clashing, run_rows=run_rows)
    assert kept.columns == clashing.columns
    assert key(r.doc_id for r in kept.collect()) == key(r[0] for r in plain_exact(ODD) if r[3])
    assert contentsort.exact_duplicates(nothing).count() == contentsort.drop_exact_duplicates(nothing).count() == 0


def test_a_text_with_many_copies_is_cut_into_runs(spark):
    rows = [(k, "a b" + " " * (k % 5), "hot") for k in range(500)] + [(1000 + k, f"t{k}", "b") for k in range(100)]
    got = contentsort.exact_duplicates(make(spark, rows), run_rows=20)
    assert key(tuple(r) for r in got.collect()) == plain_exact(rows)


def test_texts_are_shuffled_once(spark):
    rows = make(spark, ODD).select("doc_id", "text")
    plan = contentsort._sorted(rows, 100)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1


def measures(text):
    words = WORD.findall(text or "")
    at = defaultdict(list)
    for k in range(len(words) - 2):
        at[tuple(words[k : k + 3])].append(k)
    repeated = {k + d for places in at.values() if len(places) > 1 for k in places for d in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(repeated))


MORE = [(20, "a b c " * 40 + "#$ %", "a"), (21, "x y z q " * 15, None), (22, "a a a a a a", "b"),
        (23, "l1\n\nl1\r\nl1\nl2 #\n \nl2 #", "b"), (24, " ".join(f"u{k}" for k in range(60)), None)]


def test_measures_and_verdicts(spark, clashing, nothing):
    docs = clashing.unionByName(make(spark, MORE), allowMissingColumns=True)
    got = hostrules.quality_rules(docs).collect()
    want = []
    for i, t, _ in [*ODD, *MORE]:
        m = measures(t)
        want.append((i, *m, m[0] < 50 or 100 * m[4] > 50 * m[0]))
    assert key(tuple(r)[:7] for r in got) == key(want)
    kept = hostrules.keep_good(docs)
    assert kept.columns == docs.columns
    assert key(r.doc_id for r in kept.collect()) == key(r.doc_id for r in got if r.kept)
    assert hostrules.quality_rules(nothing).count() == hostrules.keep_good(nothing).count() == 0


def test_rates_of_hosts_are_shrunk(spark):
    good = " ".join(f"w{k}" for k in range(80))
    hosts = {"bad": (95, 100), "small": (1, 1), "fine": (2, 100), "good": (0, 100), None: (30, 100)}
    rows = [(0, "short" if k < fails else f"{good} {k}", h) for h, (fails, n) in hosts.items() for k in range(n)]
    rules = hostrules.document_rules(make(spark, rows).select(F.col("source").alias("host"), "text"), hostrules.Limits())
    got = {r.host: r.short for r in hostrules.rejected_hosts(rules, hostrules.Limits(max_host_rate=0.0)).collect()}
    rates = [f / n for f, n in hosts.values()]
    mean = sum(rates) / len(rates)
    var = sum((r - mean) ** 2 for r in rates) / len(rates)
    strength = max(0.0, mean * (1 - mean) / var - 1)
    for host, (fails, n) in hosts.items():
        rate = (fails + mean * strength) / (n + strength)
        assert math.isclose(got[host], rate) if rate > 0 else host not in got
    docs = make(spark, rows)
    assert {r.source for r in hostrules.keep_good(docs, limits=hostrules.Limits(max_host_rate=0.6)).select("source").collect()} == {
        h for h, (f, n) in hosts.items() if (f + mean * strength) / (n + strength) <= 0.6 and f < n}


def plain_slots(turns, slots_, seed):
    """The filled table, with each shard's whole order written out."""
    orders = {}
    for s in sorted(turns):
        offset, skip = slots._number(seed, "offset", s) % slots_, slots._number(seed, "skip", s) % (slots_ - 1) + 1
        orders[s] = [(offset + k * skip) % slots_ for k in range(slots_)]
        assert sorted(orders[s]) == list(range(slots_))
    owner = {}
    while len(owner) < slots_:
        for s in sorted(turns):
            for _ in range(turns[s]):
                free = next((x for x in orders[s] if x not in owner), None)
                if free is not None:
                    owner[free] = s
    return [owner[k] for k in range(slots_)]


def test_slots_are_claimed_by_turns(spark, clashing, nothing):
    turns = {"a": 1, "b": 2, "c": 1, "d": 1}
    owner = slots.fill_slots(turns, 101)
    assert owner == plain_slots(turns, 101, "slots")
    assert max(abs(Counter(owner)[s] - 101 * t / 5) for s, t in turns.items()) <= 2
    got = slots.shard_rows(clashing, turns, slots=101).select("row.*", "key", F.col("slot").alias("_slot"), "shard").collect()
    assert len(got) == len(ODD)
    for r in got:
        number = int(hashlib.md5(f"slots:key:{'' if r.key is None else r.key}".encode()).hexdigest()[:15], 16)
        assert (r._slot, r.shard) == (number % 101, owner[number % 101])
    assert slots.shard_rows(nothing, turns, slots=101).count() == 0
    with pytest.raises(ValueError):
        slots.fill_slots(turns, 100)


def test_losing_a_shard_moves_few_other_slots():
    turns = {f"s{k}": 1 for k in range(16)}
    before, after = slots.fill_slots(turns), slots.fill_slots({s: 1 for s in turns if s != "s3"})
    moved = sum(a != b for a, b in zip(before, after) if a != "s3")
    assert moved < 0.1 * len(before)


def plain_mix(rows, mix):
    """Copies of each row by position, from the same permutation in plain numbers."""
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    ticket = [int(hashlib.md5(f"{mix.seed}:{'' if i is None else i}".encode()).hexdigest()[:15], 16) for i, _, _ in rows]
    total = defaultdict(int)
    for (_, _, s), n in zip(rows, size):
        total[s] += n
    full = {s: n / sum(total.values()) for s, n in total.items() if n}

    def weights(a):
        z = sum(p**a for p in full.values())
        return {s: p**a / z for s, p in full.items()}

    def fits(a):
        w = weights(a)
        if mix.entropy_share is not None:
            return -sum(x * math.log(x) for x in w.values()) >= mix.entropy_share * math.log(len(w))
        return max(w[s] / full[s] for s in w) / min(w[s] / full[s] for s in w) <= mix.max_epochs

    low, high = 0.0, 1.0
    for _ in range(30):
        mid = (low + high) / 2
        if fits(mid) == (mix.entropy_share is not None):
            low = mid
        else:
            high = mid
    a = low if mix.entropy_share is not None else high
    if mix.entropy_share is not None and fits(1.0):
        a = 1.0
    if mix.max_epochs is not None and fits(0.0):
        a = 0.0
    w = weights(a)
    copies = []
    for k, (_, _, s) in enumerate(rows):
        if not total[s]:
            copies.append(1)
            continue
        if mix.budget == mixing.ALL:
            target = round(w[s] * sum(total.values()))
        else:
            target = math.floor(total[s] * (max(full.values()) / full[s]) ** (1 - a))
        until = sum(n for (_, _, o), n, x in zip(rows, size, ticket) if o == s and x <= ticket[k])
        rest = target % total[s]
        copies.append(target // total[s] + (1 if rest and until <= rest else 0))
    return copies


@pytest.mark.parametrize("mix", [mixing.Mix(entropy_share=0.9, budget=mixing.ALL), mixing.Mix(max_epochs=2.0),
                                 mixing.Mix(max_epochs=1e9), mixing.Mix(entropy_share=0.1, budget=mixing.ALL)])
def test_mixing(spark, nothing, mix):
    sized = [(100 + k, "w " * (k % 40), f"s{k * k % 7 % 4}" if k % 3 else "hot") for k in range(150)]
    rows = [(i, t, s) for i, t, s in ODD if i not in (5, 6)] + sized
    docs = make(spark, rows, ("tokens", "copies", "of", "ticket", "_time", "row"))
    want = Counter()
    for (i, t, s), n in zip(rows, plain_mix(rows, mix)):
        want[(i, s, len(WORD.findall(t or "")))] += n
    want = +want
    got = mixing.mixed_copies(docs, mix).collect()
    assert Counter((r.doc_id, r.source, r.n_tokens) for r in got) == want
    assert all(r.block == 0 and r.copy >= 0 for r in got)
    again = mixing.mix_rows(docs, mix)
    assert again.columns == docs.columns
    assert Counter((r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in again.collect()) == want
    if mix.max_epochs:
        assert {r.doc_id for r in got} == {i for i, _, _ in rows}
    assert mixing.mixed_copies(nothing, mix).count() == mixing.mix_rows(nothing, mix).count() == 0


def test_blocks_hold_the_weights(spark):
    rows = [(k, "w " * 10, "a" if k % 4 else "b") for k in range(2000)]
    mix = mixing.Mix(entropy_share=0.99, budget=mixing.ALL, block_tokens=2000)
    got = mixing.mixed_copies(make(spark, rows), mix).groupBy("block", "source").agg(F.sum("n_tokens").alias("n")).collect()
    assert {r.block for r in got} == set(range(10))
    whole = {s: sum(r.n for r in got if r.source == s) for s in "ab"}
    assert all(abs(r.n - whole[r.source] / 10) <= 20 for r in got)
