import math
import random
import struct
import zlib
from collections import Counter, defaultdict

import xxhash

from tallyroom.llm import chat, sharding

CONV = "conv_id long, turn long, role string, text string, name string, perspective string"


def test_every_participant_is_the_assistant_once(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob x", None), (1, 2, "bob x", None), (1, 3, None, "who"),
            (2, 0, "system", "alone"), (None, 0, "ann", "lost"), (3, 5, "ann", "")]
    df = spark.createDataFrame([(*r, "n", "p") for r in rows], CONV)
    got = chat.perspectives(df).collect()
    assert Counter((r.conv_id, r.perspective) for r in got) == {
        (1, "ann"): 5, (1, "bob x"): 5, (2, None): 1, (None, None): 1, (3, "ann"): 1}
    for r in got:
        target = r.rendered[r.mask_start:r.mask_end]
        if r.role == "assistant":
            assert r.rendered == f"<|im_start|>assistant\n{target}\n" and target.endswith("<|im_end|>")
        else:
            assert target == ""
        assert r.rendered.count("<|im_start|>") == 1 and r.rendered.count("<|im_end|>") == 1
    ann = {(r.turn, r.role, r.name, r.rendered) for r in got if (r.conv_id, r.perspective) == (1, "ann")}
    assert ann == {(0, "system", None, "<|im_start|>system\nbe kind<|im_end|>\n"),
                   (1, "assistant", None, "<|im_start|>assistant\nhi <||im_end|><|im_end|>\n"),
                   (2, "user", "bob_x", "<|im_start|>user name=bob_x\n<|im_end|>\n"),
                   (3, "user", "unknown", "<|im_start|>user name=unknown\nwho<|im_end|>\n")}
    assert chat.perspectives(df.limit(0)).collect() == []


def check(got, rows, n):
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(j, [])) for j in range(n)]
    assert max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(n))
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want


def test_even_shards_keep_copies_together(make_docs):
    rng = random.Random(1)
    rows = [(i, f"text é {rng.randrange(300)}") for i in range(900)]
    got = sharding.shards(make_docs(rows), n=5).collect()
    check(got, rows, 5)
    text = dict(rows)
    places = defaultdict(set)
    for r in got:
        places[text[r.doc_id]].add(r.shard)
    assert sum(len(p) > 1 for p in places.values()) <= 5  # a group at most at each shard's edge


def test_a_group_larger_than_a_shard_and_edges(make_docs):
    rows = [(i, "same") for i in range(400)] + [(1000 + i, f"own {i}") for i in range(200)] + [(None, None), (None, None), (7, ""), (7, ""), (8, "x" * 100_000)]
    check(sharding.shards(make_docs(rows), n=6).collect(), rows, 6)
    few = [(1, "a"), (2, "a"), (3, None)]
    check(sharding.shards(make_docs(few), n=24).collect(), few, 24)
    assert sharding.shards(make_docs([])).collect() == []


def mixed(*values):
    """The 64-bit hash of longs (Python int) and ints ((value,))."""
    seed = 42
    for v in values:
        raw = struct.pack("<i", v[0]) if isinstance(v, tuple) else struct.pack("<q", v)
        seed = xxhash.xxh64(raw, seed=seed).intdigest()
    return seed - (1 << 64) if seed >> 63 else seed


def plain_rounds(label, weight, hubs_of, quotas, rounds):
    """The same rounds node by node."""
    n, held, cuts = len(quotas), None, []
    members = defaultdict(list)
    for node, hubs in hubs_of.items():
        for h in hubs:
            members[h].append(node)
    for turn in range(rounds + 1):
        votes = {node: [sum(weight[m] for h in hubs for m in members[h] if label[m] == j) for j in range(n)]
                 for node, hubs in hubs_of.items()}
        free = quotas if held is None else [max(q - h, 0) for q, h in zip(quotas, held)]
        held = [sum(weight[m] for m in label if label[m] == j) for j in range(n)]
        cuts.append(sum(weight[m] * (sum(v) - v[label[m]]) for m, v in votes.items()) / 2)
        wish = {}
        for node, v in votes.items():
            anchor = min(hubs_of[node])
            open_ = [(v[j] * 64 + mixed(anchor, (j,)) % 64, -j) for j in range(n) if sum(v) - v[j] <= free[j] and (v[j] > 0 or turn >= 2)]
            to = -max(open_)[1] if open_ else label[node]
            if to != label[node]:
                wish[node] = (to, (62 - int(math.log2(sum(v)))) * 16 + mixed(anchor, (turn,)) % 16)
        last = [10 ** 9] * n
        while True:
            size = list(held)
            for m, (to, t) in wish.items():
                if t <= last[to]:
                    size[label[m]] -= weight[m]
                    size[to] += weight[m]
            full = [j for j in range(n) if size[j] > max(quotas[j], held[j])]
            if not full:
                break
            for j in full:
                over = size[j] - max(quotas[j], held[j])
                for t in sorted({t for to, t in wish.values() if to == j and t <= last[j]}, reverse=True):
                    over -= sum(weight[m] for m, w in wish.items() if w == (j, t))
                    last[j] = t - 1
                    if over <= 0:
                        break
        moving = {m: to for m, (to, t) in wish.items() if t <= last[to]}
        if turn == rounds or not moving:
            return label, cuts
        for m, to in moving.items():
            held[label[m]] -= weight[m]
            held[to] += weight[m]
        label = {**label, **moving}


def test_rounds_equal_plain_ones_and_cut_less(spark):
    rng = random.Random(3)
    nodes = list(range(300))
    label, weight = {m: rng.randrange(4) for m in nodes}, {m: 1 + (m % 50 == 0) for m in nodes}
    hubs_of = {m: {m // 6, *([100 + m // 20] if m % 7 == 0 else [])} for m in nodes}  # copies, and looser groups across them
    labels = spark.createDataFrame([(m, weight[m], label[m]) for m in nodes], "node long, weight long, label int")
    links = spark.createDataFrame([(m, h, m % 3) for m, hubs in hubs_of.items() for h in hubs], "node long, hub long, salt int")
    quotas = [80] * 4
    got, cuts = sharding.propagate(labels, links, quotas, 5)
    want, plain_cuts = plain_rounds(label, weight, hubs_of, quotas, 5)
    rows = got.collect()
    assert {r.node: r.label for r in rows} == want and cuts == plain_cuts
    assert cuts[-1] < cuts[0] / 2  # the looser groups pull apart some of what copies bind
    assert all(sum(r.weight for r in rows if r.label == j) <= max(80, sum(weight[m] for m in nodes if label[m] == j)) for j in range(4))


def test_copies_come_together_where_there_is_room(spark):
    labels = spark.createDataFrame([(m, 1, m * 7 % 4) for m in range(240)], "node long, weight long, label int")
    links = labels.selectExpr("node", "node div 6 AS hub", "cast(node % 3 AS int) AS salt")
    got, cuts = sharding.propagate(labels, links, [80] * 4)
    rows = got.collect()
    assert cuts == sorted(cuts, reverse=True) and cuts[-1] == 0 and all(r.united for r in rows)
    assert max(Counter(r.label for r in rows).values()) <= 80


def test_quotas_hold_when_every_row_is_linked():
    asked = [(0, 1, 5, 10), (1, 2, 5, 10), (2, 0, 5, 10)]
    assert sharding._granted(asked, [10, 10, 10], [10, 10, 10]) == [5, 5, 5]  # moves in a ring need no free room
    last = sharding._granted(asked[:2], [10, 10, 10], [10, 10, 10])
    assert last[2] < 5 and last[1] < 5
