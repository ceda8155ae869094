"""Operators against brute force on small random inputs, hot keys included."""

import random
from datetime import date
import re
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tallyroom.operators import joins as J
from tallyroom.operators import swaps
from tallyroom.operators.ranking import exact_rank, top_n
from tallyroom.operators.sets import missing_values, prefer
from tallyroom.operators.swaps import cheapest_unused, ranked_catalog
from tallyroom.plans import compliance, graph, ideas, marketing, recipes

RNG = random.Random(7)


def test_longest_term_both_ways_match_brute_force(spark):
    terms = ["ring", "small ring", "rod", "a", "ring rod", "x+y", "ing", "spring"]
    alphabet = ["ring", "small", "rod", "zzz", "x+y", "spring", "q", "é", "rin"]
    texts = [" ".join(RNG.choices(alphabet, k=RNG.randint(0, 6))).upper() for _ in range(60)] + [""]
    td = spark.createDataFrame(list(enumerate(texts)), "id int, body string")
    vd = spark.createDataFrame([(t, t.upper()) for t in terms] + [("", "empty")], "term string, value string")

    def brute(text):
        hits = [t.upper() for t in terms if t.upper() in text]
        return min((h for h in hits if len(h) == max(map(len, hits))), default=None)

    want = [brute(t) for t in texts]
    got = J.longest_term(td, "body", "id", vd, "term", "value").orderBy("id").collect()
    assert [r.value for r in got] == want


def test_longest_term_with_a_large_dictionary(spark):
    """More terms than a single expression could hold, some longer than the looked-up piece."""
    terms = [f"product number {i}" for i in range(3000)]
    vd = spark.createDataFrame([(t, t) for t in terms], "term string, value string")
    td = spark.createDataFrame([(1, "xx PRODUCT NUMBER 2999 yy product number 5"), (2, "product number"), (3, None)], "id int, body string")
    got = {r.id: r.value for r in J.longest_term(td, "body", "id", vd, "term", "value").collect()}
    assert got == {1: "product number 2999", 2: None, 3: None}


def test_join_any_id_matches_once(spark):
    facts = spark.createDataFrame([("1",), ("2",), ("9",)], "res_id string")
    stores = spark.createDataFrame([("s1", 1, 1), ("s2", 1, 2), ("s3", None, 2)], "store string, z bigint, w bigint")
    got = J.join_any_id(facts, "res_id", stores, {"z": "Z", "w": "W"}, tag="platform")
    assert sorted(tuple(r) for r in got.select("res_id", "store", "platform").collect()) == [
        ("1", "s1", "Z"), ("1", "s2", "Z"), ("2", "s2", "W"), ("2", "s3", "W")]


def test_cheapest_unused_matches_brute_force(spark):
    items = [(f"i{n:02d}", f"r{n % 3}", float(RNG.randint(1, 9)) if n % 7 else None) for n in range(40)]
    used = [(f"o{o}", RNG.choice(items)[0]) for o in range(8) for _ in range(RNG.randint(0, 12))]
    used += [("hot", i) for i, _, _ in items if i != "i05"]
    owners = [f"o{o}" for o in range(8)] + ["hot"]
    catalog = ranked_catalog(spark.createDataFrame(items, "item string, g string, price double"), "g", "price", "item")
    wanted = spark.createDataFrame([(o, f"r{g}") for o in owners for g in range(3)], "owner string, g string")
    mine = spark.createDataFrame(sorted(set(used)), "owner string, item string")
    for k in (1, 2, 5):
        got = {(r.owner, r.g, r.item) for r in cheapest_unused(wanted, mine, catalog, "owner", "g", "item", k).collect()}
        want = set()
        for o in owners:
            for g in ("r0", "r1", "r2"):
                free = [i for i in items if i[1] == g and (o, i[0]) not in set(used)]
                free.sort(key=lambda i: (i[2] is not None, i[2] or 0, i[0]))
                want |= {(o, g, i[0]) for i in free[:k]}
        assert got == want


def test_exact_rank_equals_one_global_sort(spark):
    data = [(i, RNG.choice([1, 1, 1, 2, 5]), RNG.randint(0, 3)) for i in range(200)]
    df = spark.createDataFrame(data, "id int, a int, b int")
    got = {r.id: r.rk for r in exact_rank(df, [], [-F.col("a"), F.col("b")], [F.asc("id")], "rk").collect()}
    want = {d[0]: n + 1 for n, d in enumerate(sorted(data, key=lambda d: (-d[1], d[2], d[0])))}
    assert got == want
    grouped = exact_rank(df, ["b"], [F.col("a")], [F.asc("id")], "rk").collect()
    for b in range(4):
        order = sorted((d for d in data if d[2] == b), key=lambda d: (d[1], d[0]))
        assert [r.id for r in sorted((g for g in grouped if g.b == b), key=lambda r: r.rk)] == [d[0] for d in order]


def test_similar_names_match_brute_force(spark):
    pool = ["dark", "nut", "bar", "oat", "date", "mini", "big"]
    names = sorted({" ".join(RNG.sample(pool, RNG.randint(1, 5))) for _ in range(40)} | {"Nut  Bar", "nut bar"})
    got = {(r.name_a, r.name_b) for r in ideas.similar_names(
        spark.createDataFrame([(n,) for n in names * 3], "nm string"), "nm", 0.6).collect()}
    words = {n: set(n.lower().split()) for n in names}
    want = {(a, b) for a, b in combinations(names, 2) if round(len(words[a] & words[b]) / len(words[a] | words[b]), 4) >= 0.6}
    assert got == want


def test_replay_edits(spark):
    lines = spark.createDataFrame([("r", "a", 100.0, 5.0), ("r", "b", 40.0, 0.0), ("r", "c", 10.0, 0.0)],
                                  "recipe_id string, ingredient_id string, qty_net_g double, loss_pct double")
    edits = spark.createDataFrame(
        [("r", 1, "SCALE", "a", 0.85, False), ("r", 2, "SET", "b", 60.0, False), ("r", 3, "SCALE", "b", 0.5, False),
         ("r", 4, "ZERO", "c", 0.0, False), ("r", 5, "ADD", "d", 20.0, False), ("r", 6, "SET", "a", 1.0, True)],
        "recipe_id string, round_no bigint, kind string, ingredient_id string, amount double, withdrawn boolean")
    got = {r.ingredient_id: (r.qty_net_g, r.loss_pct) for r in recipes.replay_edits(lines, edits).collect()}
    assert got == {"a": (85.0, 5.0), "b": (30.0, 0.0), "d": (20.0, 0.0)}


def test_sets_and_graph(spark):
    present = spark.createDataFrame([("s1", "x"), ("s2", "y"), ("s2", "x")], "s string, v string")
    assert [tuple(r) for r in missing_values(present, "s", present, "v").collect()] == [("s1", "y")]
    a = spark.createDataFrame([("k1", "new")], "k string, v string")
    b = spark.createDataFrame([("k1", "old"), ("k2", "old")], "k string, v string")
    assert sorted(tuple(r) for r in prefer(a, b, "k").collect()) == [("k1", "new"), ("k2", "old")]
    members = spark.createDataFrame([("c", "b"), ("b", "a"), ("a", None)], "id string, parent string")
    assert graph.ancestor_closure(members, "id", "parent").count() == 6
    chain = spark.range(9).selectExpr("id", "nullif(id - 1, -1) AS parent")  # deeper than any fixed number of levels here
    assert graph.ancestor_closure(chain, "id", "parent").count() == 45
    with pytest.raises(ValueError):
        graph.ancestor_closure(spark.createDataFrame([(1, 2), (2, 1)], "id int, parent int"), "id", "parent")


def test_more_probes_than_a_block(spark):
    vectors = spark.range(100).selectExpr("id", "array(cos(id), sin(id)) AS v")
    got = graph.vector_neighbors(vectors, vectors, "id", "v", 2)
    assert got.count() == 200 and got.select("probe_id").distinct().count() == 100


def test_top_n_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = top_n(df, ["k"], [F.desc("id")], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_left_join_with_one_hot_key(spark):
    """90 % of the rows have no key: they come back unmatched, and do not meet in one partition."""
    left = spark.range(1000).selectExpr("CAST(id AS STRING) AS id", "CASE WHEN id % 10 = 0 THEN CAST(id % 7 AS STRING) END AS k")
    right = spark.createDataFrame([("0", "a"), ("3", "b"), (None, "never")], "k string, v string")
    got = J.left_join(left, right, ["k"], ["id"])
    assert got.columns == ["id", "k", "v"] and got.count() == 1000
    assert got.where("k IS NULL AND v IS NOT NULL").isEmpty()
    assert got.where("v IS NOT NULL").count() == left.where("k IN ('0', '3')").count()
    parts = left.where("k IS NULL").withColumn("p", F.pmod(F.xxhash64("id"), F.lit(1024))).select("p").distinct().count()
    assert parts > 200


def test_swaps_with_one_role(spark):
    """All owners want the same role: the k cheapest they do not use."""
    catalog = spark.range(1, 21).selectExpr("CAST(id AS STRING) AS item", "'Base' AS role", "id AS pos")
    used = spark.range(50).selectExpr("CAST(id AS STRING) AS owner", "CAST(id % 4 + 1 AS STRING) AS item")
    wanted = spark.range(50).selectExpr("CAST(id AS STRING) AS owner", "'Base' AS role")
    got = cheapest_unused(wanted, used, catalog, "owner", "role", "item", 3)
    assert got.count() == 150
    for o in (0, 1, 5):
        want = [p for p in range(1, 21) if p != o % 4 + 1][:3]
        assert sorted(r.pos for r in got.where(f"owner = '{o}'").collect()) == want


def test_only_anchors_become_rows(spark):
    """Terms that begin alike meet few texts by their rarest piece; rows follow the true candidates."""
    rng = random.Random(3)
    terms = [f"ALMOND BAR {x}" for x in ("COCOA", "DATE", "HONEY MIX", "Ñandú (9%)")] + ["oat", "x.y", "é", "SEEDS AND NUTS", "日本の棒チョコ味"]
    filler = ["almond bar", "almonds", "barely", "cocoa", "date", "seeds and", "nuts", "日本", "plain", "zz"]
    texts = [(i, " ".join(rng.choice(filler) for _ in range(20)) + (" " + rng.choice(terms).lower() + " end" if i % 3 == 0 else "")) for i in range(300)]
    texts += [(1000, None), (1001, ""), (None, "oat"), (1002, "b\n" * 5000 + "Seeds and NUTS")]
    t = spark.createDataFrame(texts, "id long, body string")
    d = spark.createDataFrame([(x, f"v{i}") for i, x in enumerate(terms)] + [("", "none"), ("OAT", "v0b")], "term string, v string")
    got = {r.id: r.v for r in J.longest_term(t, "body", "id", d, "term", "v").collect()}
    value = {x.upper(): f"v{i}" for i, x in enumerate(terms)} | {"OAT": "v0b"}
    want, true = {}, 0
    for i, body in texts:
        found = sorted((x for x in value if i is not None and body and x in body.upper()), key=lambda x: (-len(x), x))
        true += len(found)
        want[i] = value[found[0]] if found else None
    assert got == want
    anchors = J.anchored_terms(d, "term", "v")
    assert anchors.select("__piece").distinct().count() == anchors.count()
    found = t.where("id IS NOT NULL").select(F.col("id").alias("__key"), F.upper("body").alias("__text"))
    assert true / 2 <= J.anchor_hits(found, anchors).count() <= 2 * true
    assert J.longest_term(t, "body", "id", d.limit(0), "term", "v").where("v IS NOT NULL").isEmpty()


@pytest.mark.parametrize("vocabulary, most, threshold", [(20, 6, 0.6), (300, 4, 0.6), (30, 16, 0.6), (15, 8, 0.75), (12, 13, 0.5)])
def test_similar_names_against_all_pairs(spark, vocabulary, most, threshold):
    rng = random.Random(most)
    words = [f"w{i}" for i in range(vocabulary)]
    names = sorted({rng.choice([" ", "-", " , "]).join(rng.choices(words, k=rng.randint(1, most))) for _ in range(150)} | {"", "?!"})
    sets = {n: set(re.findall("[a-z0-9]+", n)) for n in names}
    want = {(a, b, round(len(sets[a] & sets[b]) / len(sets[a] | sets[b]), 4)) for a, b in combinations(names, 2)
            if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold}
    df = spark.createDataFrame([(n,) for n in names] * 2 + [(None,)], "nm string")
    rows = ideas.similar_names(df, "nm", threshold).collect()
    assert {(r.name_a, r.name_b, r.similarity) for r in rows} == want and len(rows) == len(want)


def test_rows_that_meet_follow_the_similar_pairs(spark):
    """Names over 20 words: whoever meets is similar, so joined rows grow as the result does."""
    rng = random.Random(1)
    per_pair = []
    for size in (300, 600):
        sets = {tuple(sorted(rng.sample(range(20), rng.randint(3, 6)))) for _ in range(size)}
        df = spark.createDataFrame([([f"w{x}" for x in s], len(s)) for s in sets], "words array<string>, n int")
        keys = ideas._name_keys(df, 0.6)
        a, b = (keys.where(f"n = {side}").toDF(side + "w", side + "n", "shared", "x", "y") for side in ("lo", "hi"))
        met = a.join(b, ["shared", "x", "y"]).where("x < y OR low < hiw").count()
        similar = sum(len(set(p) & set(q)) >= 0.6 * len(set(p) | set(q)) for p, q in combinations(sets, 2))
        per_pair.append(met / similar)
    assert all(1 <= x <= 3 for x in per_pair), per_pair


def test_neighbors_are_exact_and_few_are_scored(spark):
    rng = random.Random(5)
    centers = [[rng.gauss(0, 1) for _ in range(12)] for _ in range(40)]
    rows = [(i, [x + rng.gauss(0, 0.06) for x in centers[i % 40]]) for i in range(1200)]
    rows += [(2000 + i, rows[7][1]) for i in range(15)] + [(3000, [0.0] * 12), (3001, None)]  # ties, and no direction
    vectors = spark.createDataFrame(rows, "id long, v array<float>")
    probes = vectors.where("id % 9 = 0 OR id >= 2000")

    def cosine(a, b):
        if not a or not b or not any(a) or not any(b):
            return None
        return sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) ** 0.5 * sum(y * y for y in b) ** 0.5)

    held = {r.id: r.v for r in vectors.collect()}
    got = {}
    for r in graph.vector_neighbors(vectors, probes, "id", "v", 6).collect():
        got.setdefault(r.probe_id, {})[r["rank"]] = (r.neighbor_id, r.similarity)
    assert set(got) == {i for i in held if i % 9 == 0 or i >= 2000}
    for i, found in got.items():
        sims = sorted(((cosine(held[i], v), j) for j, v in held.items() if j != i),
                      key=lambda x: (x[0] is None, -round(x[0] or 0, 9), x[1]))[:6]
        assert [x[0] for _, x in sorted(found.items())] == [j for _, j in sims], i
        assert all(a is b is None or abs(a - b) < 2e-6 for (a, _), (_, (_, b)) in zip(sims, sorted(found.items())))
    ready = [df.where("id < 3000").selectExpr(f"id AS {a}", f"CAST(v AS array<double>) AS {b}",
                                             f"sqrt(aggregate(v, 0D, (s, x) -> s + x * x)) AS {c}")
             for df, (a, b, c) in ((vectors, ("id", "v", "norm")), (probes, ("probe_id", "pv", "pn")))]
    scored = graph.neighbor_candidates(*ready, 6).count()
    assert scored < 0.3 * ready[0].count() * ready[1].count()


def test_few_vectors_leave_ranks_to_those_without_direction(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = {(r.probe_id, r["rank"]): r.neighbor_id for r in graph.vector_neighbors(df, df, "id", "v", 3).collect()}
    assert got == {(1, 1): 4, (1, 2): 2, (1, 3): 3, (4, 1): 1, (4, 2): 2, (4, 3): 3, (2, 1): 1, (2, 2): 3, (2, 3): 4, (3, 1): 1, (3, 2): 2, (3, 3): 4}


def test_a_long_chain_closes_in_few_rounds(spark, monkeypatch):
    real, writes = graph.written_once, []
    monkeypatch.setattr(graph, "written_once", lambda df, label: writes.append(label) or real(df, label))
    members = spark.range(200).selectExpr("id", "nullif(id - 1, -1) AS parent")
    rows = graph.ancestor_closure(members, "id", "parent")
    assert rows.count() == 200 * 201 // 2 and rows.where("depth <> descendant - ancestor").isEmpty()
    assert len(writes) <= 1 + 2 * 8


def test_regulation_counts_against_sets(spark):
    rng = random.Random(9)
    pool = ["oat", "date", "salt", "cocoa", "bar", "milk"]
    products = [(f"s{i}", " ".join(rng.choices(pool, k=2))) for i in range(60)] + [(None, "oat bar")]
    suppliers = [(f"s{rng.randrange(70)}", rng.choice(["p1", "p2", "p3", "p4", None])) for _ in range(90)]
    changes = [(f"c{i}", " ".join(rng.choices([*pool, "zinc", "lead"], k=rng.randint(0, 3)))) for i in range(40)] + [("c99", None), (None, "oat")]
    frames = [spark.createDataFrame(x, f"{y} string") for x, y in ((changes, "id string, body"), (products, "sku string, name"),
                                                                  (suppliers, "sku string, supplier_id"))]
    got = {tuple(r) for r in compliance.regulation_impact(frames[0], "id", "body", frames[1], "sku", "name", frames[2]).collect()}
    want = set()
    for i, body in changes:
        hit = {w for w in (body or "").split() if w in pool and any(w in n.split() for _, n in products)}
        skus = {s for s, n in products if hit & set(n.split())}
        if i and hit:
            want.add((i, len(hit), len(skus), len({p for s, p in suppliers if s in skus and s})))
    assert got == want


def test_a_hubs_neighbours_are_many_rows(spark):
    edges = spark.range(5000).selectExpr("'hub' AS src", "'t' AS type", "concat('n', id % 4000) AS dst").unionByName(
        spark.createDataFrame([("a", "t", "x"), ("a", "t", "y"), ("a", "t", "x"), ("b", "u", None), (None, "t", "z")], "src string, type string, dst string"))
    parts = graph.related_parts(edges, size=100).collect()
    hub = [r.neighbours for r in parts if r.src == "hub"]
    assert 35 <= len(hub) <= 40 and max(map(len, hub)) < 200 and sorted(sum(hub, [])) == sorted(f"n{i}" for i in range(4000))
    whole = {(r.src, r.type): r.neighbours for r in graph.related_grouped(edges).collect()}
    assert whole["hub", "t"] == sorted(f"n{i}" for i in range(4000)) and whole["a", "t"] == ["x", "y"] and whole[None, "t"] == ["z"]


def test_unused_lists_are_one_row_per_owner(spark):
    """An owner that uses more of the first items than are looked at first, one that is wanted twice, one without a name."""
    catalog = spark.range(1, 301).selectExpr("CAST(id AS STRING) AS item", "'Base' AS role", "id AS pos")
    used = spark.createDataFrame([("a", str(i)) for i in range(1, 201)] * 2 + [("b", "2"), (None, "1")], "owner string, item string")
    wanted = spark.createDataFrame([("a", "Base"), ("b", "Base"), ("b", "Base"), ("b", "none"), (None, "Base")], "owner string, role string")
    found, head = swaps.unused_lists(swaps.owner_groups(wanted, "owner", "role"), used, catalog, "owner", "role", "item", 2, ["pos"])
    assert found.count() == 3 and head.count() == 202
    rows = cheapest_unused(wanted, used, catalog, "owner", "role", "item", 2).collect()
    assert sorted((r.owner or "", r.pos) for r in rows) == [("", 1), ("", 2), ("a", 201), ("a", 202), ("b", 1), ("b", 1), ("b", 3), ("b", 3)]


def test_paths_are_grouped_once_per_hop(spark):
    start = spark.createDataFrame([(1,), (1,), (2,)], "id bigint")
    hops = [spark.createDataFrame([(1, 5), (1, 5), (1, 6), (2, 6)], "src bigint, dst bigint"),
            spark.createDataFrame([(5, 9), (6, 9), (6, 8)], "src bigint, dst bigint")]
    got = graph.khop_paths(start, hops)
    assert {(r.origin, r.node): r.paths for r in got.collect()} == {(1, 9): 3, (1, 8): 1, (2, 9): 1, (2, 8): 1}
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 3


def test_previous_month_needs_no_second_history(spark):
    rows = [("s", "c", date(2026, 1, 1), 1.0, 10.0), ("s", "c", date(2026, 2, 1), 2.0, 20.0), ("s", "c", date(2026, 4, 1), 4.0, 40.0),
            (None, "c", date(2026, 1, 1), 5.0, 50.0), (None, "c", date(2026, 2, 1), 6.0, 60.0), ("s", "c", None, 7.0, 70.0)]
    got = marketing.with_previous_month(spark.createDataFrame(
        rows, "master_store_id string, campaign_id string, month date, roi double, ad_spend_rs double"))
    assert [(r.prev_roi, r.prev_spend_rs) for r in got.where("roi = 2").collect()] == [(1.0, 10.0)]
    assert got.count() == 6 and got.where("prev_roi IS NOT NULL").count() == 1
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_many_to_many_rows_are_spread(spark):
    from tallyroom.operators.joins import join_many

    left = spark.createDataFrame([(f"e{i}", "hot" if i % 10 else f"k{i}") for i in range(400)] + [("x", None), (None, "hot")],
                                 "event_id string, k string")
    right = spark.createDataFrame([(f"s{i}", "hot") for i in range(30)] + [("s30", "k10"), ("s31", None), ("s30", "k10")],
                                  "sku string, k string")
    got = join_many(left, right, ["k"], "event_id")
    want = left.join(right, "k").select(got.columns)
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    sizes = got.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions"))  # not as few as the small inputs need
    assert max(sizes) < 0.9 * sum(sizes)  # the hot key is more than 0.99 of the rows


def test_rows_written_in_buckets_are_not_moved_again(spark):
    from tallyroom.sources.sinks import written_once

    rows = spark.range(200).selectExpr("CASE WHEN id % 7 > 0 THEN CAST(id % 7 AS STRING) END AS k", "id AS v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = written_once(rows, "buckets", by=["k"])
        sums = kept.join(kept.groupBy("k").agg(F.sum("v").alias("s")), "k")
        assert "Exchange" not in sums._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.k, r.v) for r in sums.collect()) == sorted((r.k, r.v) for r in rows.where("k IS NOT NULL").collect())
        assert kept.count() == 200 and not [x for x in spark.catalog.listTables() if x.name.startswith("written_")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_what_a_write_has_moved_is_cleared(spark):
    """Shuffle files of a finished write do not stay on the disk until the query ends."""
    import os
    import time

    from tallyroom.sources.sinks import written_once

    root = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0]

    def moved():
        return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.startswith("shuffle_") and f.endswith(".data")}

    before = moved()
    written_once(spark.range(100000).selectExpr("id % 5000 AS k", "id AS v").groupBy("k").agg(F.sum("v")), "cleared")
    until = time.time() + 20
    while moved() - before and time.time() < until:
        time.sleep(0.2)
    assert not moved() - before


def test_stock_rows_travel_with_the_columns_that_are_wanted(spark):
    from datetime import date

    from tallyroom.plans import inventory
    from tallyroom.sources.tables import GivenTables

    columns = ["sku_id", "master_store_id", "total_stock", "expired_stock"]
    stock = spark.createDataFrame(
        [("a", "s", 5.0, 1.0, e, q, d, date(2026, 1, x), w, True, 3) for x, e, q, d, w in
         [(1, 2.0, 3.0, date(2026, 2, 1), "x"), (1, 2.0, 9.0, date(2026, 3, 1), "y"), (1, 1.0, 9.0, date(2026, 3, 1), None)]]
        + [("b", "s", 7.0, None, None, None, None, None, None, None, None)],
        "sku_id string, master_store_id string, total_stock double, safe_stock double, expired_stock double, "
        "qty_expiring_within_risk_days double, soonest_expiry date, report_date date, wastage_flag string, low_stock_flag boolean, "
        "shelf_life_days int")
    t = GivenTables(spark, flagged_inventory=stock)
    few = inventory.v_stocked_at(t, columns)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, inventory.v_stocked_at(t).select(*columns).collect()))
    assert [r.expired_stock for r in few.orderBy("sku_id").collect()] == [2.0, None]
    window = [x for x in few._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window" in x][0]
    assert "shelf_life_days" not in window and "expired_stock" in window


def test_tags_travel_as_bits(spark):
    from tallyroom.plans.recipes import name_tags, tag_bits, tags_of

    names = spark.createDataFrame([("Almond milk",), ("caster sugar",), ("oats",), (None,)], "n string")
    got = names.select(name_tags(F.col("n")).alias("a")).select("a", tags_of(tag_bits(F.col("a"))).alias("b")).collect()
    assert all(r.a == r.b for r in got) and got[0].a == ["NUT"]
