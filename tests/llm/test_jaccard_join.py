import itertools
import random
import re

import numpy as np
import pytest

from tallyroom.llm import jaccard_join
from tallyroom.llm.wordhash import BLOCK, Words


def shingles(text):
    w = re.findall("[^ \t-\r]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


def corpus(rng, groups=25):
    words = [f"w{i}" for i in range(400)]
    line = " ".join(rng.choices(words, k=30))  # shared by many
    rows = []
    for _ in range(groups):
        base = rng.choices(words, k=rng.choice([3, 5, 8, 60, 200]))
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            text = " ".join(copy)
            rows.append((len(rows), text.upper() if rng.random() < 0.3 else text + ("\n" + line if rng.random() < 0.5 else "")))
    return rows


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_against_brute_force(make_docs):
    rows = corpus(random.Random(3))
    assert result(jaccard_join.near_copies(make_docs(rows))) == brute(rows)


@pytest.mark.parametrize("short, long", [(2, 2), (3, 100_000)])
def test_long_lists_lose_no_link(make_docs, monkeypatch, short, long):
    """Lists over SHORT go through hubs, and with few long lists named to the tasks many stay so."""
    monkeypatch.setattr(jaccard_join, "SHORT", short)
    monkeypatch.setattr(jaccard_join, "LONG", long)
    rows = corpus(random.Random(5), 30)
    rng, base = random.Random(6), [f"b{i}" for i in range(40)]
    for i in range(30):  # a group in which not every pair links
        copy = list(base)
        for p in rng.sample(range(40), rng.randint(0, 2)):
            copy[p] = f"x{i}"
        rows.append((1000 + i, " ".join(copy)))
    assert result(jaccard_join.near_copies(make_docs(rows))) == brute(rows)


def test_a_chain_past_the_hubs_size(make_docs, monkeypatch):
    """The longest of a chain is the hub; the shortest links only with the one between, whose size the
    hub's list does not rule out."""
    monkeypatch.setattr(jaccard_join, "SHORT", 1)
    monkeypatch.setattr(jaccard_join, "LONG", 2)
    words = [f"w{i}" for i in range(104)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:89])), (3, " ".join(words[:76])), (4, " ".join(words[:20]))]
    want = brute(rows)
    assert {i: c for i, (_, c) in want.items()} == {1: 1, 2: 1, 3: 1, 4: 4}
    assert result(jaccard_join.near_copies(make_docs(rows))) == want


def test_edges(make_docs, spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(1, None), (2, ""), (3, " \n"), (4, text), (5, text), (5, text), (6, "one two"), (7, "ONE  two"), (None, text), (8, None)]
    got = [tuple(r) for r in jaccard_join.near_copies(make_docs(rows)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [
        (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 46, 4), (5, 46, 4), (5, 46, 4), (6, 1, 6), (7, 1, 6), (None, 46, 4), (8, 0, 8)]))
    kept = jaccard_join.one_per_component(make_docs(rows), jaccard_join.near_copies(make_docs(rows)))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "6", "8", "None"]
    assert jaccard_join.near_copies(make_docs([])).collect() == []


def test_word_hashes_do_not_depend_on_blocks():
    words = Words(b" \n")
    long = b"x" * (BLOCK + 5)
    text = np.frombuffer(b"Abc d\nabc " * 150_000 + long + b" d " + long, np.uint8)
    got = words.hashes(text)
    one = words.hashes(np.frombuffer(b"abc d", np.uint8))
    assert len(got) == 450_003 and (got[:450_000:3] == one[0]).all() and (got[1:450_000:3] == one[1]).all()
    assert got[-1] == got[-3] and got[-2] == one[1] and len(set(got.tolist())) == 3


def group(rng, size):
    """Near copies of one text; two with two changed words each do not link."""
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(size):
        copy = list(base)
        for p in rng.sample(range(120), rng.randint(0, 2)):
            copy[p] = f"x{i}y{p}"
        rows.append((i, " ".join(copy)))
    return rows


def one_line(rng, size):
    """Different short texts behind one common line."""
    line = " ".join(f"l{i}" for i in range(14))
    return [(i, line + " " + " ".join(f"u{i}v{j}" for j in range(rng.randint(1, 8)))) for i in range(size)]


@pytest.mark.parametrize("make, sizes", [(group, (150, 300)), (one_line, (300, 600))])
def test_compared_pairs_grow_with_the_group(make_docs, monkeypatch, make, sizes):
    real, pairs = jaccard_join._tested, []

    def counted(spark, rows, candidates, k, percent):
        tested = real(spark, rows, candidates, k, percent)
        pairs[-1] += tested.count()
        return tested

    monkeypatch.setattr(jaccard_join, "_tested", counted)
    monkeypatch.setattr(jaccard_join, "SHORT", 8)
    monkeypatch.setattr(jaccard_join, "LONG", 8)
    for size in sizes:
        pairs.append(0)
        rows = make(random.Random(size), size)
        assert result(jaccard_join.near_copies(make_docs(rows))) == brute(rows)
    assert 0 < pairs[1] <= 2.6 * pairs[0], pairs
    assert pairs[1] <= jaccard_join.SHORT * sizes[1], pairs
