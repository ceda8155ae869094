"""Nodes, edges, hierarchies, vocabularies and catalogs as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.operators.ranking import top_n
from tallyroom.operators.sets import union_rows
from tallyroom.plans.products import product_facets, v_product_ingredient
from tallyroom.sources.readers import literal_table
from tallyroom.sources.sinks import written_once


def load_nodes(df: DataFrame, entity_type: str, key: str, properties: dict[str, str]) -> DataFrame:
    """Table -> nodes ``(entity_type, id, properties)``, one per id; of several
    rows with one id the smallest value of each property is kept."""
    picked = df.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("id")).agg(
        *[F.min(F.col(c).cast("string")).alias(p) for p, c in properties.items()])
    props = F.map_from_arrays(F.array(*[F.lit(p) for p in properties]), F.array(*[F.col(p) for p in properties]))
    return picked.select(F.lit(entity_type).alias("entity_type"), "id", props.alias("properties"))


def load_edges(df: DataFrame, edge_type: str, src: str, dst: str) -> DataFrame:
    return df.where(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(
        F.lit(edge_type).alias("type"), F.col(src).cast("string").alias("src"),
        F.col(dst).cast("string").alias("dst")).distinct()


def channel_nodes(t) -> DataFrame:
    """One node type fed by the channel list and the store list."""
    return union_rows(load_nodes(t.dim_channel, "Channel", "channel_id", {"type": "channel_type"}),
                      load_nodes(t.master_store, "Channel", "master_store_id", {"type": "type"}))


def graph_nodes(t) -> DataFrame:
    return union_rows(
        load_nodes(product_facets(t), "Products", "sku", {"product_name": "display_name", "mrp": "mrp_inr"}),
        load_nodes(t.dim_ingredient, "Materials", "ingredient_id",
                   {"material_name": "ingredient_name", "material_type": "category"}),
        channel_nodes(t))


def graph_edges(t) -> DataFrame:
    return union_rows(load_edges(v_product_ingredient(t), "requires_material", "sku", "ingredient_id"),
                      load_edges(t.map_product_channel, "stocked_at", "sku", "channel_id"),
                      load_edges(t.master_store, "channel_located_in", "master_store_id", "city_id"))


def cardinality_violations(edges: DataFrame, many_to_one: list[str]) -> DataFrame:
    """Sources of a many-to-one edge with more than one target."""
    return (edges.where(F.col("type").isin(many_to_one)).groupBy("type", "src")
            .agg(F.count_distinct("dst").alias("targets")).where("targets > 1"))


def dangling_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose target is not a node."""
    return edges.join(nodes.select(F.col("id").alias("dst")).distinct(), "dst", "left_anti")


def khop_paths(start: DataFrame, hops: list[DataFrame]) -> DataFrame:
    """Number of paths from each start id along a chain of ``(src, dst)`` edge
    tables. Paths are counted per (origin, node) after every hop, never listed."""
    paths = start.select(F.col("id").alias("origin"), F.col("id").alias("node")).distinct().withColumn(
        "paths", F.lit(1).cast("bigint"))
    for hop in hops:  # an edge that is there twice is two paths, so the edges need no grouping of their own
        step = hop.select(F.col("src").alias("node"), "dst")
        paths = paths.join(step, "node").groupBy("origin", F.col("dst").alias("node")).agg(F.sum("paths").alias("paths"))
    return paths


def related_parts(edges: DataFrame, size: int = 10_000) -> DataFrame:
    """Different neighbours of every source by edge type, in rows of about ``size``: (src, type, part,
    neighbours), sorted within a part. The number of parts follows a count made before anything is
    gathered, so a source with very many neighbours is many rows of many tasks."""
    pairs = edges.select("src", "type", "dst").distinct()
    parts = pairs.groupBy(F.col("src").alias("s"), F.col("type").alias("t")).agg(F.ceil(F.count("*") / size).alias("parts"))
    return (pairs.join(parts, F.col("src").eqNullSafe(F.col("s")) & F.col("type").eqNullSafe(F.col("t")))
            .withColumn("part", F.pmod(F.xxhash64("dst"), "parts").cast("int"))
            .groupBy("src", "type", "part").agg(F.array_sort(F.collect_list("dst")).alias("neighbours")))


def related_grouped(edges: DataFrame) -> DataFrame:
    """Neighbours of every source, grouped by edge type: the parts of :func:`related_parts` merged into
    one row, for sources whose neighbours fit one."""
    return related_parts(edges).groupBy("src", "type").agg(
        F.array_sort(F.flatten(F.collect_list("neighbours"))).alias("neighbours"))


def ancestor_closure(members: DataFrame, child: str, parent: str) -> DataFrame:
    """``(descendant, ancestor, depth)`` for every member, itself included, up to the
    roots whatever the depth. Pointers are doubled: a round joins all paths of fewer than 2^k
    links with those of exactly 2^k, so a chain of 1,000 members takes 10 rounds.
    A member that is its own ancestor is an error."""
    out = members.select(F.col(child).alias("descendant"), F.col(child).alias("ancestor"), F.lit(0).cast("bigint").alias("depth"))
    jump = written_once(members.where(F.col(parent).isNotNull()).select(F.col(child).alias("__from"), F.col(parent).alias("__to")), "closure")
    length = 1
    while not jump.isEmpty():
        longer = written_once(out.join(jump, F.col("ancestor") == F.col("__from")).select(
            "descendant", F.col("__to").alias("ancestor"), (F.col("depth") + length).alias("depth")), "closure")
        if not longer.where("descendant = ancestor").isEmpty():
            raise ValueError("the hierarchy has a cycle")
        out = out.unionByName(longer)
        again = jump.select(F.col("__from").alias("__to"), F.col("__to").alias("__next"))
        jump = written_once(jump.join(again, "__to").select("__from", F.col("__next").alias("__to")), "closure")
        length *= 2
    return out


def hier_rollup(df: DataFrame, levels: list[str], aggregates: list[Column]) -> DataFrame:
    """Measures at every level of a hierarchy and in total."""
    return df.rollup(*levels).agg(F.grouping_id().cast("bigint").alias("level_id"), *aggregates)


# ---- vocabularies --------------------------------------------------------------------

VOCABULARIES = {
    # fixed values: vocabulary -> members in order, with their labels
    "ProductStatus": [("Live", "Live"), ("OccasionallyLive", "Occasionally Live"), ("UnderTrial", "Under Trial"),
                      ("UnderDevelopment", "Under Development"), ("Discontinued", "Discontinued")],
    "VegNonVeg": [("Veg", "Veg"), ("NonVeg", "Non-Veg")],
    "ChannelType": [("Delivery", "Delivery aggregator"), ("QCommerce", "Quick commerce"), ("D2C", "Direct-to-consumer"),
                    ("Retail", "Modern retail"), ("HoReCa", "HoReCa"), ("Gifting", "Gifting"), ("QSR", "QSR"),
                    ("Corporate", "Corporate"), ("Vending", "Vending")],
    "IdeaStage": [("Capture", "Capture"), ("Triage", "Triage"), ("Feasibility", "Feasibility"), ("Pipeline", "Pipeline"),
                  ("Development", "Development"), ("Launch", "Launch"), ("Rejected", "Rejected")],
}


def vocabulary(spark, name: str) -> DataFrame:
    rows = [(m, i + 1, label) for i, (m, label) in enumerate(VOCABULARIES[name])]
    return literal_table(spark, rows, "id string, sort_order bigint, label string")


def vocab_check(df: DataFrame, column: str, vocab: DataFrame) -> DataFrame:
    """Values outside the vocabulary with how often they occur."""
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))
    return values.join(vocab, values["value"] == vocab["id"], "left_anti")


def vocab_label_order(df: DataFrame, column: str, vocab: DataFrame) -> DataFrame:
    return df.join(vocab.withColumnRenamed("id", column), column, "left")


# ---- catalogs ----------------------------------------------------------------------------

def catalog_explode(catalog: DataFrame, key: str, arrays: dict[str, str]) -> DataFrame:
    """Array attributes of catalog entries as one edge table ``(key, relation,
    value)``; an entry with an empty list keeps a row with a NULL value."""
    return union_rows(*[catalog.select(key, F.lit(rel).alias("relation"), F.explode_outer(col).alias("value"))
                        for col, rel in arrays.items()])


def catalog_symmetry(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs that only one of two catalogs declares."""
    a = left.select(*keys).distinct().withColumn("__l", F.lit(True))
    b = right.select(*keys).distinct().withColumn("__r", F.lit(True))
    both = a.join(b, keys, "full")
    return both.where(F.col("__l").isNull() | F.col("__r").isNull()).select(
        *keys, F.when(F.col("__l").isNull(), "missing_in_left").otherwise("missing_in_right").alias("mismatch"))


# ---- stored vectors -----------------------------------------------------------------------

PIVOTS = 64  # stored vectors that name the cells
BIN = 0.05  # radians: vectors of a cell are looked up by their angle to the pivot


def _dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def _angle(cosine):
    return F.acos(F.least(F.greatest(cosine, F.lit(-1.0)), F.lit(1.0)))


def vector_cells(stored: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Vectors (id, v, norm) with the cell ``c`` of their nearest pivot and the angle ``a`` to it; the pivots
    as one row's array; one row with the cells' number of vectors and range of angles."""
    unit = F.transform("v", lambda x: x / F.col("norm"))
    first = stored.select(F.xxhash64("id").alias("h"), "id", unit.alias("u")).orderBy("h", "id").limit(PIVOTS)
    first = first.agg(F.array_sort(F.collect_list(F.struct("h", "id", "u"))).alias("p"))
    pivots = first.select(F.col("p.u").alias("pivots"))
    cosines = F.transform("pivots", lambda p: _dot(F.col("v"), p) / F.col("norm"))
    near = (stored.withColumn("pivots", pivots.scalar()).withColumn("cosines", cosines).drop("pivots")
            .withColumn("best", F.array_max("cosines")))
    cells = written_once(near.select("id", "v", "norm", F.expr("int(array_position(cosines, best) - 1)").alias("c"), _angle(F.col("best")).alias("a"))
                         .withColumn("bin", F.floor(F.col("a") / BIN)), "vector-cells")
    sizes = cells.groupBy("c").agg(F.count("*").alias("n"), F.min("bin").alias("lo"), F.max("bin").alias("hi")).agg(
        F.array_sort(F.collect_list(F.struct("c", "n", "lo", "hi"))).alias("cells"))
    return cells, pivots, sizes


def _scored(pairs: DataFrame) -> DataFrame:
    return pairs.select("probe_id", F.col("id").alias("neighbor_id"), F.try_divide(_dot(F.col("pv"), F.col("v")), F.col("pn") * F.col("norm")).alias("sim"))


def neighbor_candidates(stored: DataFrame, probes: DataFrame, k: int) -> DataFrame:
    """Pairs of probes (probe_id, pv, pn) and stored vectors (id, v, norm) that hold each probe's ``k`` nearest.

    A probe first meets its nearest cells that hold more than ``k`` vectors; its k-th best angle there
    bounds the search. By the triangle inequality only vectors whose angle to their pivot differs from
    the probe's by no more than the bound can be nearer; those meet it by cell and bin of angles.
    """
    cells, pivots, sizes = vector_cells(stored)
    probes = probes.withColumn("pivots", pivots.scalar()).withColumn("cells", sizes.scalar())
    probes = probes.withColumn("reach", F.array_sort(F.transform("cells", lambda x: F.struct(
        _angle(_dot(F.col("pv"), F.get(F.col("pivots"), x["c"])) / F.col("pn")).alias("t"), x["c"].alias("c"), x["n"].alias("n"),
        x["lo"].alias("lo"), x["hi"].alias("hi"))))).drop("pivots", "cells")
    nearest = F.expr(f"""aggregate(reach, struct(cast(array() as array<int>) as c, 0L as seen),
        (s, x) -> if(s.seen > {k}, s, struct(concat(s.c, array(x.c)) as c, s.seen + x.n as seen))).c""")
    first = probes.select("probe_id", "pv", "pn", F.explode(nearest).alias("c")).join(cells, "c").where("probe_id <> id")
    best = top_n(_scored(first), ["probe_id"], [F.desc_nulls_last("sim"), F.asc("neighbor_id")], k, "rank")
    bound = best.groupBy("probe_id").agg(F.when(F.count("sim") >= k, _angle(F.min("sim")) + 1e-6).otherwise(4.0).alias("tau"))
    spans = F.expr(f"""filter(transform(reach, x -> struct(x.c as c, x.t as t,
        greatest(x.lo, bigint(floor((x.t - tau) / {BIN}))) as lo, least(x.hi, bigint(floor((x.t + tau) / {BIN}))) as hi)), x -> x.lo <= x.hi)""")
    looked = (probes.join(bound, "probe_id").select("probe_id", "pv", "pn", "tau", F.inline(spans))
              .select("probe_id", "pv", "pn", "tau", "t", "c", F.explode(F.sequence("lo", "hi")).alias("bin")))
    return looked.join(cells, ["c", "bin"]).where("probe_id <> id AND abs(t - a) <= tau").select("probe_id", "pv", "pn", "id", "v", "norm")


def vector_neighbors(vectors: DataFrame, probes: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """The ``k`` nearest stored vectors by cosine for each probe, exactly; ties go to the smaller id.

    Candidates are pruned by :func:`neighbor_candidates`. Vectors without a direction (null, zero, NaN)
    have no similarity and come last, by id, where a probe has fewer than ``k`` others.
    """
    def prepared(df, names):
        v = F.col(vector).cast("array<double>")
        return df.select(F.col(key).alias(names[0]), v.alias(names[1]), F.sqrt(_dot(v, v)).alias(names[2]))

    def lowest(rows):
        ids = rows.select("id").where("id IS NOT NULL").orderBy("id").limit(k + 1).agg(F.array_sort(F.collect_list("id")).alias("ids"))
        return ids.scalar()

    stored, probe = prepared(vectors, ("id", "v", "norm")), prepared(probes, ("probe_id", "pv", "pn"))
    able = lambda c: (F.col(c) > 0) & ~F.isnan(c) & (F.col(c) < float("inf"))
    best = written_once(top_n(_scored(neighbor_candidates(stored.where(able("norm")), probe.where(able("pn")), k)), ["probe_id"],
                              [F.desc_nulls_last("sim"), F.asc("neighbor_id")], k, "rank").drop("rank"), "vector-best")
    counts = best.groupBy("probe_id").agg(F.count("*").alias("found"))
    short = (probe.select("probe_id", F.coalesce(able("pn"), F.lit(False)).alias("able")).join(counts, "probe_id", "left")
             .where(F.coalesce("found", F.lit(0)) < k))
    rest = (short.withColumn("ids", F.when(F.col("able"), lowest(stored.where(~F.coalesce(able("norm"), F.lit(False))))).otherwise(lowest(stored)))
            .select("probe_id", F.explode("ids").alias("neighbor_id")).where("probe_id <> neighbor_id")
            .withColumn("sim", F.lit(None).cast("double")))
    return top_n(best.unionByName(rest), ["probe_id"], [F.desc_nulls_last("sim"), F.asc("neighbor_id")], k, "rank").select(
        "probe_id", "rank", "neighbor_id", F.round("sim", 6).alias("similarity"))
