import math
import random
import re
from collections import Counter

import duckdb
import pytest

from tallyroom.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda x: x.group().lower(), t) for t in TERM.findall(text or "")]


def brute(rows, items, k=50):
    """The definition, every document against every item."""
    bags = [(doc_id, Counter(terms(text))) for doc_id, text in rows]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    n_docs, n_terms = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    by_item = {}
    for item_id, text in items:
        if item_id is not None and text is not None:
            by_item.setdefault(item_id, set()).update(terms(text))
    out = []
    for item_id, wanted in by_item.items():
        found = []
        for d, b, n in bags:
            m = 100 - 50 + 50 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b[t] // (1000 * b[t] + 20 * m))
                        for t in wanted if t in b)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item_id, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return sorted(out)


def got(df):
    return sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def rows_and_items():
    rng = random.Random(1)
    pool = [f"w{i}" for i in range(60)] + ["Ñandú", "ÜBER", "日本", "X1", "the", "the", "the"]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(0, 25)))) for i in range(300)]
    rows += [(1000 + i, "the w1 w2 copies") for i in range(120)] + [(1500 + i, "the w1 w2 other") for i in range(80)]  # one class, two texts
    rows += [(2000, None), (2001, ""), (2002, "?!"), (None, "the w1 w2 copies"), (7, "w7 w8"), (7, "w7 w8"), (7, "w9"), (-4, "W7, w8!"),
             (2003, "w3 " * 40_000 + "w4")]
    rng.shuffle(rows)
    items = [(i, " ".join(rng.choice(pool) for _ in range(8))) for i in range(12)]
    items += [(50, "THE w1 W1"), (51, "nowhere found"), (52, None), (53, "?"), (None, "w1"), (54, "w7"), (54, "w8"), (-1, "w3 w4")]
    return rows, items


@pytest.mark.parametrize("k, chars, cells", [(50, 4_000_000, 2_000_000), (3, 4_000_000, 40), (7, 60, 2_000_000)])
def test_against_the_definition(make_docs, spark, monkeypatch, k, chars, cells):
    monkeypatch.setattr(lexical, "CELLS", cells)
    rows, items = rows_and_items()
    bench = spark.createDataFrame([(*x, 3, "n") for x in items], "item_id long, text string, doc_id int, score string")
    assert got(lexical.search(make_docs(rows).repartition(5), bench, k=k, block_chars=chars)) == brute(rows, items, k)


def test_equal_hashes_are_told_apart(make_docs, spark, monkeypatch):
    rows, items = rows_and_items()
    bench = spark.createDataFrame(items, "item_id long, text string")
    real = lexical.F.xxhash64
    monkeypatch.setattr(lexical.F, "xxhash64", lambda *c: lexical.F.lit(7) if c[0] == "m" else real(*c))
    assert got(lexical.search(make_docs(rows), bench, k=5)) == brute(rows, items, 5)


def test_empty_tables(make_docs, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "w1")], "item_id long, text string")
    assert lexical.search(make_docs([]), some).collect() == []
    assert lexical.search(make_docs([(1, "w1")]), none).collect() == []
    assert got(lexical.search(make_docs([(1, "w1"), (2, "w1 w2"), (3, "w3")]), some)) == brute([(1, "w1"), (2, "w1 w2"), (3, "w3")], [(1, "w1")])


def test_sql_says_the_same(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    docs, bench = (spark.read.parquet(f"{folder}/{x}.parquet") for x in ("documents", "benchmark"))
    assert got(lexical.search(docs, bench)) == sorted(con.sql(lexical.SQL).fetchall())
