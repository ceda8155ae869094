import random

from tallyroom.llm import tiling


def brute_tiles(text, item, k):
    """Greedy string tiling as it is defined: the longest match of unmarked words, over and over."""
    used_t, used_i, out = set(), set(), []
    while True:
        best = (k - 1, 0, 0)
        for i in range(len(text)):
            for j in range(len(item)):
                n = 0
                while i + n < len(text) and j + n < len(item) and text[i + n] == item[j + n] \
                        and i + n not in used_t and j + n not in used_i:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < k:
            return sorted(out)
        out.append((i, j, n))
        used_t.update(range(i, i + n))
        used_i.update(range(j, j + n))


def test_tiles_against_the_definition():
    rng = random.Random(1)
    for _ in range(60):
        item = [rng.choice("abcdef") for _ in range(rng.randint(3, 30))]
        text = [rng.choice("abcdef") for _ in range(rng.randint(0, 40))] + item[5:] + item[:7]
        pairs = [(i, j) for i in range(len(text) - 2) for j in range(len(item) - 2) if text[i:i + 3] == item[j:j + 3]]
        assert sorted(tiling.tiles_of(pairs, 3)) == brute_tiles(text, item, 3)


def words(n, tag):
    return [f"{tag}{i}" for i in range(n)]


def test_leaks_in_any_order_and_clean_texts(make_docs, spark):
    item, other = words(40, "a"), words(3, "tiny")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(other)), (3, None), (None, "x y z q r"), (4, "!!"), (5, " ".join(item))],
                                  "item_id long, text string")
    rows = [(1, "pre " + " ".join(item).upper() + " post"), (2, " ".join(item[20:] + ["mid"] + item[:20])),
            (3, " ".join(item[:20]) + " " + " ".join(words(200, "c"))), (4, " ".join(words(99, "d"))), (5, None), (6, ""),
            (7, "so tiny0, tiny1; TINY2."), (8, " ".join(item[:5])), (1, "pre " + " ".join(item).upper() + " post"), (None, "a0 a1"),
            (9, " ".join(words(30_000, "f") + item[3:] + words(10, "g")))]
    for block_chars in (1 << 20, 100):  # one block of the benchmark, and several
        got = tiling.leaks(make_docs(rows), bench, block_chars=block_chars).collect()
        assert len(got) == len(rows)
        hit = sorted((r.doc_id, r.item_id, r.covered, r.item_words) for r in got if r.contaminated)
        assert hit == [(1, 1, 40, 40), (1, 1, 40, 40), (2, 1, 40, 40), (7, 2, 3, 3), (9, 1, 37, 40)]
        left = tiling.clean(make_docs(rows), bench, block_chars=block_chars)
        assert sorted(str(r.doc_id) for r in left.collect()) == ["3", "4", "5", "6", "8", "None"]
        assert left.columns == make_docs(rows).columns
    assert tiling.leaks(make_docs([]), bench).collect() == []
    assert tiling.leaks(make_docs(rows), bench.limit(0)).where("contaminated").isEmpty()
