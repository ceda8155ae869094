import hashlib
import random
import re

from pyspark.sql import functions as F

from tallyroom.llm import pii


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        c = int(c)
        total += c if i % 2 == 0 else c * 2 - 9 * (c > 4)
    return total % 10 == 0


RULES = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
         ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
         ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(re.sub("[^0-9]", "", s)) <= 19 and luhn(re.sub("[^0-9]", "", s))),
         ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(re.sub("[^0-9]", "", s)) <= 15)]


def base(text):
    return [(k, m.start(), m.end()) for k, rx, ok in RULES for m in re.finditer(rx, text or "") if ok(m.group())]


TEXTS = [
    None, "", "nothing here", "a@b.co", "é a.b+c@x-y.example.com, x@y and @z.com a@b..c", "a@b.co@c.de q@r.s_t@u.v", "1.2.3.4.5.6.7.8 999.1.1.1 256.0.0.1",
    "000255.1.2.3 0000000000000000000001.1.1.1", "card 4111 1111 1111 1111.", "card 4111111111111112", "4111-1111-1111-1111 4111  1111 1111 1111 1111",
    "call +1 (555) 010-9999 or +12 or +1234567890123456", "+1 (826) 555-4081 190.137.223.204", "x 4111111111111111 5500005555555559 y",
    "üß 12.34.56.78 é+49 30 123456", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7", "\n10.0.0.1\n10.0.0.1", "a." * 3000 + "b@" + "c." * 3000 + "d", "7" * 5000, "1 2" * 3000,
    "tok_4111111111111111x", "😀 mail me@x.org 😀 4012888888881881",
]


def fields(r):
    return r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256


def test_base_spans_and_added_ones(make_docs):
    plain = [(100 + i, f"{t} w{i}") for i, t in enumerate(["see 4012888888881881 end", "see +1 (555) 010-1234 end", "see 10.1.2.3 end", "see 4012888888881882 end",
                                                   "see 300.1.2.3 end"] * 20)]
    rows = list(enumerate(TEXTS)) + plain
    got = {r.doc_id: r for r in pii.report(make_docs(rows)).collect()}
    for i, text in rows:
        want = base(text)
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        counts = tuple(sum(w[0] == k for w in want) for k, _, _ in RULES)
        assert fields(got[i]) == (*counts, hashlib.sha256(said.encode()).hexdigest()), text
        assert set(filter(None, said.split(","))) <= set(got[i].spans.split(","))
    # the strict pattern swallows two numbers at once; the candidates inside it are added
    inner = TEXTS.index("x 4111111111111111 5500005555555559 y")
    assert got[inner].spans == "card:2:18,card:19:35"
    phone = TEXTS.index("+1 (826) 555-4081 190.137.223.204")
    assert got[phone].spans == "ip:18:33,phone:0:17"
    assert all(got[i].spans == "" for i, t in plain if "1882 " in t or " 300." in t)


def test_repeated_rows_empty_tables_and_one_class(make_docs):
    assert pii.report(make_docs([])).collect() == []
    got = pii.report(make_docs([(1, "a@b.co"), (1, "a@b.co"), (None, "a@b.co")])).collect()
    assert [r.spans for r in got] == ["email:0:6"] * 3


def test_redaction(make_docs):
    docs = make_docs([(1, "mail a@b.co now 10.0.0.1 é"), (2, None), (3, ""), (4, "clean text 12"), (5, "+1 (826) 555-4081 4111111111111111")])
    got = {r.doc_id: (r.text, r.n_chars) for r in pii.redacted(docs, length="n_chars").collect()}
    assert got[1] == ("mail [EMAIL] now [IP] é", 23) and got[2] == (None, None) and got[3] == ("", 0) and got[4] == ("clean text 12", 13)
    assert pii.redacted(docs).columns == docs.columns


def test_overlapping_candidates_are_chosen_greedily(spark):
    rng = random.Random(4)
    cases = [[("card", 0, 10), ("card", 8, 22), ("phone", 20, 40)]]  # the middle one goes, so the first stays
    cases += [[(rng.choice(["card", "phone"]), a, a + rng.randint(1, 12)) for a in rng.choices(range(40), k=rng.randint(0, 9))] for _ in range(60)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], f"i int, a {pii.SPAN}")
    got = {r.i: {tuple(x) for x in r.s} for r in df.select("i", F.expr(pii.apart("a")).alias("s")).collect()}
    for i, case in enumerate(cases):
        stay = []
        for x in sorted(case, key=lambda x: (x[1] - x[2], x[1])):
            if all(x[2] <= o[1] or o[2] <= x[1] for o in stay):
                stay.append(x)
        assert got[i] == set(stay), case
    assert got[0] == {("card", 0, 10), ("phone", 20, 40)}


def test_trees_as_sql_equal_their_odds(spark):
    rng = random.Random(5)
    cells = [{**{f: rng.randrange(6) for f in pii.FEATURES}, "part": rng.randrange(2), "ones": rng.randrange(5), "zeros": rng.randrange(5) + 1}
             for _ in range(300)]
    model = pii.fit(cells)
    df = spark.createDataFrame([tuple(c[f] for f in pii.FEATURES) for c in cells], ", ".join(f"{f} int" for f in pii.FEATURES))
    got = df.select(F.struct(*pii.FEATURES).alias("x")).select(F.expr(model.sql("x")).alias("odds")).collect()
    assert len(model.trees) == pii.ROUNDS
    assert all(abs(r.odds - model.odds(c)) < 1e-4 for r, c in zip(got, cells, strict=True))
