"""Personal data by candidate gradient boosting, in Spark expressions only.

Strict patterns give the base spans, which always stay. High-recall generators then propose
overlapping candidates at every place where one may begin, such as a card or phone number inside
a longer run of digits that the strict pattern has to drop. Each candidate has format and context
features; gradient-boosted trees, fitted on what the strict patterns decide about candidates that
they see whole, give it a probability; a threshold per kind, calibrated on documents that the
trees have not seen, selects the candidates that are added.

All features take few values, so the training set is a table of feature cells with counts, whose
size does not depend on the corpus; the trees are fitted on that table and applied as CASE
expressions inside array functions. Nothing is exploded on the main path, no text is shuffled.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The strict patterns by kind, in possessive form, which accepts the same strings.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = [("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE)]
MARKS = {kind: f"[{kind.upper()}]" for kind, _ in KINDS}

# Generators: (kind, pattern of a candidate that begins where the pattern is found)
GENERATORS = [
    ("card", r"(?<![0-9])(?=([0-9]{4}(?:[\x20-]?[0-9]{4}){3})(?![0-9]))"),
    ("card", r"(?<![0-9])(?=([0-9]{16,19})(?![0-9]))"),
    ("phone", r"(?=(\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4})(?![0-9]))"),
    ("phone", r"(?<![0-9+.-])(?=(\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4})(?![0-9]))"),
    ("ip", r"(?<![0-9.])(?=([0-9]{1,3}(?:\.[0-9]{1,3}){3})(?![0-9]))"),
    ("email", r"(?<![A-Za-z0-9._%+-])(?=([A-Za-z0-9._%+-]{1,64}[\x20]?(?:\(at\)|\[at\])[\x20]?[A-Za-z0-9-]{1,63}"
              r"(?:[\x20]?(?:\.|\(dot\)|\[dot\])[\x20]?[A-Za-z0-9-]{2,63}){1,4})(?![A-Za-z0-9]))"),
]
SEEN = [True, True, True, False, True, False]  # can the strict patterns judge a generator's candidates?
WORDS = [r"tel|phone|call|mobil|fax|whats", r"mail|contact|write", r"card|visa|credit|amex|pay", r"\bip\b|host|server|addr",
         r"order|invoice|ref|isbn|version|serial|account|no\."]
WANTED = [3, 3, 1, 1, 4, 2]  # context class that speaks for each generator
FEATURES = ["generator", "digits", "checksum", "octets", "separators", "plus", "before", "after", "context"]
ROUNDS, RATE, PRECISION = 24, 0.4, 0.95

SPAN = "array<struct<kind:string,start:long,end:long>>"


def _cumulative(pieces: str, hits: str, shift: int) -> str:
    """(start, hit) of every match, from the pieces between matches and the matches."""
    return f"""aggregate(sequence(1, size({hits})), struct(cast(array() AS array<struct<start:long,hit:string>>) AS l, {shift}L AS at),
        (a, i) -> struct(concat(a.l, array(struct(a.at + length({pieces}[i - 1]) AS start, {hits}[i - 1] AS hit))) AS l,
                         a.at + length({pieces}[i - 1]) + {{width}} AS at), a -> a.l)"""


def _matches(df: DataFrame, name: str, pattern: str, group: int, needs: Column) -> DataFrame:
    """Adds ``name``: array of (start, hit). Group 1 marks a zero-width pattern; a character in front
    keeps the split pieces and the matches in step."""
    text = F.col("body") if group == 0 else F.concat(F.lit("\n"), F.col("body"))
    df = df.withColumn(f"{name}_h", F.when(needs & F.col("body").rlike(pattern),
                                           F.regexp_extract_all(text, F.lit(pattern), F.lit(group))))
    df = df.withColumn(f"{name}_p", F.when(F.col(f"{name}_h").isNotNull(), F.split(text, pattern, -1)))
    width = f"length({name}_h[i - 1])" if group == 0 else "0"
    found = _cumulative(f"{name}_p", f"{name}_h", 0 if group == 0 else -1).replace("{width}", width)
    empty = "cast(array() AS array<struct<start:long,hit:string>>)"
    with_digits = "transform({a}, x -> struct(x.start AS start, x.hit AS hit, regexp_replace(x.hit, '[^0-9]', '') AS d))"
    return (df.withColumn(name, F.expr(f"CASE WHEN size({name}_h) > 0 THEN {with_digits.format(a=found)} "
                                       f"ELSE {with_digits.format(a=empty)} END"))
            .drop(f"{name}_h", f"{name}_p"))


LUHN = """aggregate(sequence(1, length(x.d)), 0, (s, i) -> s + CASE WHEN (length(x.d) - i) % 2 = 0
    THEN ascii(substring(x.d, i, 1)) - 48
    ELSE (ascii(substring(x.d, i, 1)) - 48) * 2 - CASE WHEN substring(x.d, i, 1) >= '5' THEN 9 ELSE 0 END END) % 10 = 0"""


def _accepts(kind: str) -> str:
    """SQL test of a strict match ``x.hit``."""
    return {"email": "true",
            "ip": "forall(split(x.hit, '[.]'), p -> length(ltrim('0', p)) <= 3 AND coalesce(try_cast(right(p, 3) AS int), 256) <= 255)",
            "card": f"length(x.d) BETWEEN 16 AND 19 AND {LUHN}",
            "phone": "length(x.d) BETWEEN 8 AND 15"}[kind]


def _based(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Adds ``body``, the strict matches ``raw`` and the accepted ones ``base``, by kind and start."""
    df = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"))
    digit = F.col("body").rlike("[0-9]")
    needs = {"email": F.contains("body", F.lit("@")), "ip": digit, "card": digit, "phone": F.contains("body", F.lit("+"))}
    for kind, pattern in KINDS:
        df = _matches(df, f"m_{kind}", pattern, 0, needs[kind])
    spans = "transform({a}, x -> struct('{k}' AS kind, x.start AS start, x.start + length(x.hit) AS end))"
    raw = "concat(" + ", ".join(spans.format(a=f"m_{k}", k=k) for k, _ in KINDS) + ")"
    base = "concat(" + ", ".join(spans.format(a=f"filter(m_{k}, x -> {_accepts(k)})", k=k) for k, _ in KINDS) + ")"
    return df.withColumns({"raw": F.expr(raw), "base": F.expr(base)}).drop(*[f"m_{k}" for k, _ in KINDS])


def _candidates(df: DataFrame) -> DataFrame:
    """Adds ``candidates``: structs with kind, start, end, the features and a weak label.

    Label 1: an accepted strict span is this very candidate. 0: the strict pattern matched exactly
    it and dropped it; or, for generators that the strict patterns cannot judge, the words in front
    do not speak for it. Null: part of a longer strict match, which says nothing about it.
    """
    digit = F.col("body").rlike("[0-9]{3}|[0-9][.][0-9]")
    at = F.contains("body", F.lit("(at)")) | F.contains("body", F.lit("[at]"))
    parts = []
    for g, (kind, pattern) in enumerate(GENERATORS):
        df = _matches(df, f"c{g}", pattern, 1, at if kind == "email" else digit)
        context = "CASE " + " ".join(f"WHEN f RLIKE '{w}' THEN {i + 1}" for i, w in enumerate(WORDS)) + " ELSE 0 END"
        side = "CASE WHEN s = '' OR s RLIKE '^\\\\s$' THEN 0 WHEN s RLIKE '^\\\\p{L}$' THEN 1 WHEN s RLIKE '^[0-9]$' THEN 2 ELSE 3 END"

        def let(value: str, name: str, body: str) -> str:
            return f"element_at(transform(array({value}), {name} -> {body}), 1)"

        features = {
            "generator": str(g),
            "digits": "least(length(x.d), 20)",
            "checksum": f"CASE WHEN length(x.d) BETWEEN 1 AND 19 AND {LUHN} THEN 1 ELSE 0 END",
            "octets": "CASE WHEN x.hit RLIKE '^[0-9.]+$' AND forall(split(x.hit, '[.]'), p -> coalesce(try_cast(p AS bigint), 256) <= 255) "
                      "THEN 1 ELSE 0 END",
            "separators": "least(length(regexp_replace(x.hit, '[^\\\\x20().-]', '')), 6)",
            "plus": "CASE WHEN x.hit LIKE '+%' THEN 1 ELSE 0 END",
            "before": let("CASE WHEN x.start = 0 THEN '' ELSE substring(body, cast(x.start AS int), 1) END", "s", side),
            "after": let("substring(body, cast(x.start + length(x.hit) + 1 AS int), 1)", "s", side),
            "context": let("lower(substring(body, greatest(cast(x.start AS int) - 23, 1), least(cast(x.start AS int), 24)))",
                           "f", context),
        }
        made = ", ".join(f"cast({sql} AS int) AS {name}" for name, sql in features.items())
        label = (f"CASE WHEN exists(base, b -> b.start = x.start AND b.end = x.end) THEN 1 "
                 f"WHEN exists(raw, r -> r.kind = '{kind}' AND r.start = x.start AND r.end = x.end) THEN 0 END"
                 if SEEN[g] else f"CASE WHEN x.context = {WANTED[g]} THEN 1 ELSE 0 END")
        parts.append(f"transform(transform(c{g}, x -> struct('{kind}' AS kind, x.start AS start, "
                     f"x.start + length(x.hit) AS end, {made})), x -> named_struct('kind', x.kind, 'start', x.start, "
                     f"'end', x.end, {', '.join(f'''{name!r}, x.{name}''' for name in FEATURES)}, 'label', {label}))")
    df = df.withColumn("candidates", F.expr(f"concat({', '.join(parts)})"))
    return df.drop(*[f"c{g}" for g in range(len(GENERATORS))])


class Boosted:
    """Trees of depth two over integer features, a log-odds start, and a threshold per generator."""

    def __init__(self, start: float, trees: list, thresholds: list[float]):
        self.start, self.trees, self.thresholds = start, trees, thresholds

    def odds(self, cell: dict) -> float:
        return self.start + sum(_leaf(t, cell) for t in self.trees)

    def sql(self, x: str) -> str:
        """Log-odds of the struct ``x`` as SQL."""
        return " + ".join([repr(self.start), *(_case(t, x) for t in self.trees)])


def _leaf(tree, cell):
    while isinstance(tree, tuple):
        feature, value, low, high = tree
        tree = low if cell[feature] <= value else high
    return tree


def _case(tree, x: str) -> str:
    if not isinstance(tree, tuple):
        return f"{tree:.6f}D"
    feature, value, low, high = tree
    return f"CASE WHEN {x}.{feature} <= {value} THEN {_case(low, x)} ELSE {_case(high, x)} END"


def _grow(cells: list[dict], depth: int):
    """One regression tree on gradients and curvatures, by exact gain."""
    def score(g, h):
        return g * g / (h + 1.0)

    total_g, total_h = sum(c["g"] for c in cells), sum(c["h"] for c in cells)
    best = (1e-6, None, None)
    for feature in FEATURES if depth else []:
        by: dict[int, list[float]] = {}
        for c in cells:
            s = by.setdefault(c[feature], [0.0, 0.0])
            s[0] += c["g"]
            s[1] += c["h"]
        g = h = 0.0
        for value in sorted(by)[:-1]:
            g, h = g + by[value][0], h + by[value][1]
            gain = score(g, h) + score(total_g - g, total_h - h) - score(total_g, total_h)
            if gain > best[0]:
                best = (gain, feature, value)
    if best[1] is None:
        return -RATE * total_g / (total_h + 1.0)
    _, feature, value = best
    return (feature, value, _grow([c for c in cells if c[feature] <= value], depth - 1),
            _grow([c for c in cells if c[feature] > value], depth - 1))


def fit(cells: list[dict]) -> Boosted:
    """Boost logistic loss on feature cells (features, part, ones, zeros). Part 0 grows the trees,
    part 1 calibrates: each generator's threshold is the lowest log-odds from which on at least
    ``PRECISION`` of part 1 are positive; without such a level nothing is added."""
    own = [c for c in cells if c["part"] == 0]
    ones, zeros = sum(c["ones"] for c in own), sum(c["zeros"] for c in own)
    if not ones or not zeros:
        # one class only: the prior decides, with a cautious pseudo-count
        zeros, ones = zeros + 1, ones + 1
    start = math.log(ones / zeros)
    for c in own:
        c["f"] = start
    trees = []
    for _ in range(ROUNDS if own else 0):
        for c in own:
            p, n = 1 / (1 + math.exp(-c["f"])), c["ones"] + c["zeros"]
            c["g"], c["h"] = n * p - c["ones"], n * p * (1 - p)
        tree = _grow(own, 2)
        trees.append(tree)
        for c in own:
            c["f"] += _leaf(tree, c)
    model = Boosted(start, trees, [])
    for g in range(len(GENERATORS)):
        graded = sorted(((model.odds(c), c["ones"], c["zeros"]) for c in cells if c["part"] == 1 and c["generator"] == g),
                        reverse=True)
        limit, yes, no = 1e9, 0, 0
        for i, (odds, a, b) in enumerate(graded):
            yes, no = yes + a, no + b
            last_of_level = i + 1 == len(graded) or graded[i + 1][0] < odds - 1e-9
            if last_of_level and yes and yes >= PRECISION * (yes + no):
                limit = odds
        model.thresholds.append(max(limit - 1e-6, 0.0))
    return model


def train(docs: DataFrame) -> Boosted:
    """Count every candidate of the corpus per feature cell and fit. The result of the counting is
    bounded by the number of cells (at most the product of the features' few values)."""
    part = F.pmod(F.xxhash64("body"), F.lit(2)).cast("string")
    # one text per candidate, so that the arrays are computed once and not once per field
    cell = "transform(candidates, x -> concat_ws(',', " + ", ".join(f"x.{f}" for f in FEATURES) + ", coalesce(x.label, 2)))"
    seen = _candidates(_based(docs, [])).select(part.alias("part"), F.explode(F.expr(cell)).alias("cell"))
    rows = seen.groupBy("part", "cell").count().orderBy("part", "cell").collect()
    cells: dict[tuple, dict] = {}
    for r in rows:
        *values, label = map(int, r.cell.split(","))
        found = cells.setdefault((r.part, *values), {"part": int(r.part), "ones": 0, "zeros": 0,
                                                     **dict(zip(FEATURES, values, strict=True))})
        if label < 2:
            found["ones" if label else "zeros"] += r["count"]
    return fit([c for c in cells.values() if c["ones"] + c["zeros"]])


def apart(spans: str) -> str:
    """SQL for those of ``spans`` (array of kind, start, end) that stay: the longest first, then the one
    that begins first, each unless it overlaps one that stays."""
    order = ("CASE WHEN l.end - l.start > r.end - r.start THEN -1 WHEN l.end - l.start < r.end - r.start THEN 1 "
             "WHEN l.start < r.start THEN -1 WHEN l.start > r.start THEN 1 ELSE 0 END")
    return (f"aggregate(array_sort({spans}, (l, r) -> {order}), cast(array() AS {SPAN}), (stay, x) -> "
            f"CASE WHEN exists(stay, o -> o.start < x.end AND x.start < o.end) THEN stay "
            f"ELSE cast(concat(stay, array(x)) AS {SPAN}) END)")


def find(docs: DataFrame, model: Boosted, keep: list[str]) -> DataFrame:
    """Adds to the columns ``keep`` of ``docs``: body (text, null as empty), base and spans (arrays of
    kind, start, end, in code points with the end exclusive; by kind as listed, then start)."""
    df = _candidates(_based(docs, keep)).drop("raw")
    limits = "array(" + ", ".join(f"{t:.6f}D" for t in model.thresholds) + ")"
    df = df.withColumn("added", F.expr(
        f"transform(filter(candidates, x -> NOT exists(base, b -> b.start < x.end AND x.start < b.end) "
        f"AND ({model.sql('x')}) >= {limits}[x.generator]), "
        "x -> struct(x.kind AS kind, x.start AS start, x.end AS end))")).drop("candidates")
    df = df.withColumn("added", F.expr(f"CASE WHEN size(added) > 1 THEN {apart('added')} ELSE added END"))
    both = "concat(base, added)"
    by_kind = ", ".join(f"array_sort(array_distinct(filter({both}, x -> x.kind = '{k}')))" for k, _ in KINDS)
    return df.withColumn("spans", F.expr(f"CASE WHEN size({both}) = 0 THEN base ELSE concat({by_kind}) END")).drop("added")


def joined(spans: str) -> str:
    return f"array_join(transform({spans}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"


def report(docs: DataFrame, model: Boosted | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_email, n_ip, n_card, n_phone (base spans),
    base_sha256, spans. A null or empty text has none; repeated rows are judged alike and other
    columns are ignored. Fits the trees on ``docs`` unless a model is given."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = find(rows, model or train(rows), ["doc_id"])
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = '{k}')) AS bigint)").alias(f"n_{k}") for k, _ in KINDS]
    return found.select("doc_id", *counts, F.sha2(F.expr(joined("base")).cast("binary"), 256).alias("base_sha256"),
                        F.expr(joined("spans")).alias("spans"))


def redacted(docs: DataFrame, model: Boosted | None = None, length: str | None = None) -> DataFrame:
    """Rows of ``docs`` with personal data in ``text`` replaced by [EMAIL], [IP], [CARD] or [PHONE].

    Spans that overlap are one stretch, named after the span that begins first (ties: the kind
    listed first). A null text stays null and other columns stay as they are, but ``length``, where
    given, is a column that gets the new text's characters."""
    others = [c for c in docs.columns if c != "text"]
    packed = docs.select("text", F.struct("text", *others).alias("row"))
    found = find(packed, model or train(docs), ["row"])
    order = F.expr("array_sort(spans, (a, b) -> CASE WHEN a.start < b.start THEN -1 WHEN a.start > b.start THEN 1 "
                   "WHEN a.end > b.end THEN -1 WHEN a.end < b.end THEN 1 ELSE 0 END)")
    mark = reduce(lambda sql, k: f"WHEN x.kind = '{k}' THEN '{MARKS[k]}' {sql}", [k for k, _ in reversed(KINDS)], "")
    text = F.expr(f"""aggregate(ordered, struct('' AS t, 0L AS at), (a, x) -> CASE
        WHEN x.start >= a.at THEN struct(concat(a.t, substring(body, cast(a.at + 1 AS int), cast(x.start - a.at AS int)),
                                                CASE {mark} END) AS t, x.end AS at)
        ELSE struct(a.t AS t, greatest(a.at, x.end) AS at) END,
        a -> concat(a.t, substring(body, cast(a.at + 1 AS int))))""")
    out = found.withColumn("ordered", order).withColumn("clean", F.when(F.size("ordered") > 0, text).otherwise(F.col("row.text")))
    new = {"text": F.col("clean"), length: F.length("clean").cast("long")}
    return out.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])
