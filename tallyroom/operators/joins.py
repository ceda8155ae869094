"""Joins the model needs beyond plain equi-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.operators.ranking import first_per

def join_any_id(facts: DataFrame, fact_id: str, entities: DataFrame, id_columns: dict[str, str],
                tag: str | None = None) -> DataFrame:
    """Join where a fact's id equals any of several id columns.

    ``id_columns`` maps a column of ``entities`` to its tag, in order of
    preference. The ids are turned into rows, which makes the match an
    equi-join; an entity whose columns hold the same id matches once, under the
    first tag.
    """
    ids = F.array(*[F.struct(F.col(c).cast("string").alias("__id"), F.lit(i).alias("__pos"),
                             F.lit(label).alias("__tag")) for i, (c, label) in enumerate(id_columns.items())])
    cols = [c for c in id_columns]
    first = F.filter(ids, lambda x: ~F.exists(
        ids, lambda y: y["__id"].eqNullSafe(x["__id"]) & (y["__pos"] < x["__pos"])) & x["__id"].isNotNull())
    rows = entities.select("*", F.inline(first)).drop("__pos", *cols)
    out = facts.join(rows, facts[fact_id] == rows["__id"], "inner").drop("__id")
    return out.withColumnRenamed("__tag", tag) if tag else out.drop("__tag")


PIECE = 8  # characters by which a longer term is looked up
BITS = 1 << 20  # of the filter over the dictionary's anchors


def anchored_terms(terms: DataFrame, term: str, value: str) -> DataFrame:
    """Upper-case terms with their value and anchor (__term, __value, __piece): the whole term if it has at
    most ``PIECE`` characters, else that run of ``PIECE`` characters which the fewest terms share."""
    words = terms.where(F.length(term) > 0).groupBy(F.upper(term).alias("__term")).agg(F.min(value).alias("__value"))
    short = words.where(F.length("__term") <= PIECE).withColumn("__piece", F.col("__term"))
    runs = words.where(F.length("__term") > PIECE).select("*", F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length("__term") - PIECE + 1), lambda i: F.substr("__term", i, F.lit(PIECE))))).alias("__piece"))
    shared = runs.groupBy("__piece").agg(F.count("*").alias("__shared"))
    rarest = (runs.join(shared, "__piece").groupBy("__term", "__value")
              .agg(F.min_by("__piece", F.struct("__shared", "__piece")).alias("__piece")))
    return short.unionByName(rarest)


def _piece_patterns(anchors: DataFrame) -> DataFrame:
    """One row: per size of anchors a look-ahead for runs whose every character stands at that place in
    some anchor. At most ``PIECE`` patterns, each no longer than the alphabet times ``PIECE``."""
    place = F.explode(F.sequence(F.lit(1), F.length("__piece")))
    chars = anchors.select("__piece", F.length("__piece").alias("n"), place.alias("i")).groupBy("n", "i").agg(
        F.array_join(F.array_sort(F.collect_set(F.concat(F.lit("\\x{"), F.hex(F.ascii(F.substr("__piece", F.col("i"), F.lit(1)))), F.lit("}")))), "").alias("c"))
    sizes = chars.groupBy("n").agg(F.array_sort(F.collect_list(F.struct("i", F.concat(F.lit("["), "c", F.lit("]")).alias("c")))).alias("c"))
    return sizes.agg(F.collect_list(F.concat(F.lit("(?s)(?=("), F.array_join(F.col("c.c"), ""), F.lit("))"))))


def _piece_bits(anchors: DataFrame) -> DataFrame:
    """One row: ``BITS`` bits as longs, those set that anchors hash to."""
    slot = F.pmod(F.xxhash64("__piece"), F.lit(BITS))
    used = (anchors.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("id"))
            .agg(F.bit_or(F.expr("shiftleft(1L, int(s & 63))")).alias("b")))
    every = anchors.sparkSession.range(0, BITS >> 6, 1, 1)
    return (every.join(used, "id", "left").agg(F.array_sort(F.collect_list(F.struct("id", F.coalesce("b", F.lit(0)).alias("b")))).alias("w"))
            .select(F.col("w.b")))


def anchor_hits(texts: DataFrame, anchors: DataFrame) -> DataFrame:
    """(__key, __piece) of runs in ``texts`` (__key, __text) that are anchors; a few that are not, by chance.
    What is no anchor is left out inside the text's row, before anything becomes a row of its own."""
    patterns, bits = _piece_patterns(anchors), _piece_bits(anchors)
    pieces = F.flatten(F.transform("__patterns", lambda p: F.regexp_extract_all(F.col("__text"), p, F.lit(1))))
    known = F.expr(f"filter(__pieces, p -> getbit(get(__bits, int(shiftright(pmod(xxhash64(p), {BITS}), 6))), int(pmod(xxhash64(p), 64))) = 1)")
    return (texts.withColumn("__patterns", F.coalesce(patterns.scalar(), F.array().cast("array<string>")))
            .withColumn("__bits", bits.scalar()).withColumn("__pieces", pieces)
            .select("__key", F.explode(F.array_distinct(known)).alias("__piece")))


def longest_term(texts: DataFrame, text: str, key: str, terms: DataFrame, term: str, value: str) -> DataFrame:
    """Add ``value`` of the longest dictionary term found inside ``text``
    (substring, case-insensitive; NULL when none is found; equal lengths are
    settled by the alphabet). Every text is searched whole.

    Texts and terms meet in an equi-join on the terms' anchors; longer terms are then looked for
    in the text. Each candidate is a row, and a text brings back its best one only. A text whose
    key is NULL gets NULL.
    """
    anchors = anchored_terms(terms, term, value)
    found = texts.where(F.col(key).isNotNull()).select(F.col(key).alias("__key"), F.upper(F.col(text)).alias("__text"))
    candidates = anchor_hits(found, anchors).join(anchors, "__piece").select("__key", "__term", "__value").distinct()
    best = (candidates.join(found, "__key")
            .where((F.length("__term") <= PIECE) | (F.instr(F.col("__text"), F.col("__term")) > 0))
            .groupBy("__key").agg(F.min_by("__value", F.struct(-F.length("__term"), "__term")).alias(value)))
    return texts.join(best, texts[key] == best["__key"], "left").drop("__key")


def left_join(left: DataFrame, right: DataFrame, keys: list[str], spread: list[str]) -> DataFrame:
    """Left equi-join on string keys where many rows of ``left`` may have no key. Those rows get a
    key of their own, made from the columns ``spread``, that nothing matches, so that they
    do not all meet in one partition."""
    none = F.lit(False)
    for k in keys:
        none = none | F.col(k).isNull()
    apart = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*spread), F.lit(1024)).cast("string"))
    renamed = right.withColumnsRenamed({k: f"__k{i}" for i, k in enumerate(keys)})
    keyed = left.withColumns({f"__k{i}": F.when(none, apart).otherwise(F.col(k)) if i == 0 else F.col(k)
                              for i, k in enumerate(keys)})
    return keyed.join(renamed, [f"__k{i}" for i in range(len(keys))], "left").drop(*[f"__k{i}" for i in range(len(keys))])


SPLITS = 8  # parts of a key's left rows in a join of many to many


def join_many(left: DataFrame, right: DataFrame, keys: list[str], spread: str) -> DataFrame:
    """Inner equi-join where a key has many rows on both sides, so the result is far larger than its inputs.

    Tasks that are sized by their input would be too few for it, so the session's own number of shuffle
    partitions is kept. A key's left rows are dealt over ``SPLITS`` parts by ``spread``, and each part meets all right
    rows of the key, so that a hot key is no single task. Rows without a key are left out before they move.
    """
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    there = F.lit(True)
    for k in keys:
        there = there & F.col(k).isNotNull()
    part = F.pmod(F.xxhash64(spread), F.lit(SPLITS)).cast("int")
    dealt = left.where(there).withColumn("__part", part).repartition(parts, *keys, "__part")
    copies = right.where(there).withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(SPLITS - 1))))
    return dealt.join(copies.repartition(parts, *keys, "__part"), [*keys, "__part"]).drop("__part")


def join_same_day(left: DataFrame, right: DataFrame, keys: dict[str, str], spread: list[str] | None = None) -> DataFrame:
    """Left equi-join on (place, item, day) given as ``{left column: right column}``. ``spread`` names
    columns that part the rows without a key, see :func:`left_join`."""
    renamed = right
    for lcol, rcol in keys.items():
        if lcol != rcol:
            renamed = renamed.withColumnRenamed(rcol, lcol)
    return left_join(left, renamed, list(keys), spread) if spread else left.join(renamed, list(keys), "left")


def attach_parent(children: DataFrame, parent_id: str, lines: DataFrame, line_parent: str) -> DataFrame:
    """A parent's rows under the child's id."""
    return children.join(lines.withColumnRenamed(line_parent, parent_id), parent_id, "inner")


def nearest_link(edges: DataFrame, src: str, dst: str, distance: str, ties: list[str] = ()) -> DataFrame:
    """The closest neighbour of every source."""
    return first_per(edges, [src], [F.asc(distance), *[F.asc(c) for c in (ties or [dst])]])
