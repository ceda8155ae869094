import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

from tallyroom.llm import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, run):
    w = WORD.findall(re.sub("[A-Z]", lambda x: x.group().lower(), text or ""))
    return [" ".join(w[i:i + k]) for k in range(1, run + 1) for i in range(len(w) - k + 1)], len(w)


def brute(rows, target, run=1, buckets=10_000, percent=10, least=20):
    """The definition, one document after the other; rows come back as sorted tuples."""
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, text in rows for f in features(text, run)[0])
    t = Counter(bucket(f) for text in target for f in features(text, run)[0])
    n_s, n_t = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in rows:
        found, n_words = features(text, run)
        weight = sum(math.floor(1000 * math.log((t[bucket(f)] + 1) * (n_s + buckets) / ((s[bucket(f)] + 1) * (n_t + buckets)))) for f in found)
        score = None
        if doc_id is not None:
            h = int(hashlib.sha256(f"2024:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, None, n_words])
    fit = sorted((r for r in out if r[5] >= least and r[0] is not None), key=lambda r: (-r[3], r[0], r[1]))
    for rank, r in enumerate(fit[:percent * len(fit) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()), key=str)


def corpus(n, seed):
    rng = random.Random(seed)
    pool = ["la", "Casa", "tree", "ñu", "7up", "x_y", "ÜBER", "日本", "don't", "a" * 50]
    rows = [(i, " ".join(rng.choice(pool[:rng.randint(2, 10)]) for _ in range(rng.randint(0, 60)))) for i in range(n)]
    return rows, [" ".join(rng.choice(pool[3:]) for _ in range(30)) for _ in range(5)]


@pytest.mark.parametrize("run, percent", [(1, 10), (2, 37), (1, 100), (1, 0)])
def test_against_the_definition(make_docs, spark, run, percent):
    rows, target = corpus(400, run)
    rows += [(1000, None), (1001, ""), (None, "w " * 40), (None, None), (-7, "casa tree " * 30), (1002, "long text ñ " * 30_000)]
    rows += [(17, rows[17][1])] * 60 + [(5, "another text of doc 5 " * 9)]  # repeated rows, and one id with two texts
    bench = spark.createDataFrame([(i, t, 1) for i, t in enumerate(target)] + [(9, None, 2)], "item_id long, text string, score int")
    df = resample.resample(make_docs(rows).repartition(4), bench, run=run, percent=percent)
    assert got(df) == brute(rows, target, run=run, percent=percent)


def test_cutoff_inside_a_group_of_equal_rows(make_docs, spark):
    rows = [(3, "w " * 25)] * 50 + [(i, "x " * 30) for i in range(10, 40)]
    bench = spark.createDataFrame([(1, "w w x")], "item_id long, text string")
    for percent in (20, 40, 55, 90):
        assert got(resample.resample(make_docs(rows), bench, percent=percent)) == brute(rows, ["w w x"], percent=percent)


def test_empty_tables(make_docs, spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert resample.resample(make_docs([]), bench).collect() == []
    rows, _ = corpus(50, 3)
    assert got(resample.resample(make_docs(rows), bench)) == brute(rows, [])


def test_cutoff_is_the_sorted_key(spark):
    rng = random.Random(4)
    for n, parts in ((1, 1), (2, 3), (97, 1), (500, 7)):
        keys = [(rng.randint(-5, 5), rng.randint(0, 30), rng.randint(0, 1)) for _ in range(n)]
        df = spark.createDataFrame(keys, "a long, b long, c long").repartition(parts)
        for k in {1, 2, n // 3, n // 2, n - 1, n} - {0}:
            if k <= n:
                key, before = resample.cutoff(df, k)
                assert key == sorted(keys)[k - 1] and before == sum(x < key for x in keys)


def test_weighted_median():
    assert resample.weighted_median([((1, 0, 0), 1), ((2, 0, 0), 1), ((9, 0, 0), 5)]) == (9, 0, 0)
    assert resample.weighted_median([((5, 0, 0), 2), ((4, 0, 0), 2)]) == (4, 0, 0)


def test_sql_says_the_same(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    docs, bench = (spark.read.parquet(f"{folder}/{x}.parquet") for x in ("documents", "benchmark"))
    assert got(resample.resample(docs, bench)) == sorted(con.sql(resample.SQL).fetchall(), key=str)
