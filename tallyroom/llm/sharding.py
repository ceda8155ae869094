"""Even shards that keep linked documents together, by balanced label propagation.

Documents are nodes, and a link says that a node belongs to a hub: equal texts share a hub, so a
group of copies is a star and never a list of pairs. Every node starts with a random shard as its
label. In each round the hubs count their members' current labels, every node hears the counts of
its hubs and asks for the label that most of its neighbours carry, among the shards that have room
for all of them; from the third round on it may also ask for a shard where it has no neighbour. A
shard grants requests, those of large neighbourhoods first, up to its quota of rows, counting
what leaves it in the same round. Rounds go on until no node moves; cut edges (pairs of linked
rows in different shards) are counted in each.

Documents whose hub did not come together, and documents without links, then fill every shard to
its exact size, group by group. A group larger than a quarter of a shard has several hubs of about
that size. Hubs are counted, and their counts brought back, by (hub, salt), so a group with a
third of all rows is many keys. The driver sees row counts per pair of shards and turn only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyroom.llm.tables import written

SHARDS = 24
ROUNDS = 8
TURNS = 16  # turns per power of two of a neighbourhood's size
CROWD = 50_000  # rows of a group from which on its rows are dealt to several buckets
LAW = "rows"  # shard sizes in rows are at most one apart
KEY = ["g", "text_crc32", "size"]  # equal texts: hash, checksum and length together


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("g"))
    # rows without a doc_id get a stable number of their own, as this result is written once
    return rows.withColumn("rid", F.coalesce("doc_id", -1 - F.monotonically_increasing_id()))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("rid", "g"), F.lit(buckets)).cast("int")


def _ranked(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """Gapless rank from 0 within ``by``: rows of earlier buckets, then the place in the bucket."""
    counts = rows.groupBy(*by, "bucket").agg(F.count("*").alias("here"))
    before = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*by, "bucket", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy(*by, "bucket").orderBy("hub", "rid", *KEY))
    return (rows.join(starts, [*by, "bucket"])
            .withColumn(name, (F.col("first") + place - 1).cast("long")).drop("first"))


def _heard(labels: DataFrame, links: DataFrame, n: int) -> DataFrame:
    """Adds to ``labels`` (node, weight, label): votes (rows per label among the members of the node's
    hubs, itself included) and anchor (its smallest hub)."""
    here = (links.join(labels, "node").groupBy("hub", "salt")
            .agg(*[F.sum(F.when(F.col("label") == j, F.col("weight")).otherwise(0)).alias(f"l{j}") for j in range(n)]))
    hubs = here.groupBy("hub").agg(F.array(*[F.sum(f"l{j}") for j in range(n)]).alias("v"), F.collect_set("salt").alias("salts"))
    told = links.join(hubs.select("hub", "v", F.explode("salts").alias("salt")), ["hub", "salt"])
    votes = told.groupBy("node").agg(F.min("hub").alias("anchor"),
                                     F.array(*[F.sum(F.col("v")[j]) for j in range(n)]).alias("votes"))
    return labels.join(votes, "node")


def _granted(asked: list[tuple[int, int, int, int]], held: list[int], quotas: list[int]) -> list[int]:
    """Per shard the last turn whose requests it grants, -1 for none.

    ``asked`` has (from, to, turn, rows). All requests are granted at first; a shard that they would
    fill above its quota takes back its last turns until it fits with what leaves it. That may keep
    rows in other shards, so this goes on until every shard fits. No shard grows above its quota."""
    n = len(held)
    last = [max((t for _, _, t, _ in asked), default=-1)] * n
    into: list[dict[int, int]] = [{} for _ in range(n)]
    for _, to, turn, rows in asked:
        into[to][turn] = into[to].get(turn, 0) + rows
    while True:
        size = list(held)
        for start, to, turn, rows in asked:
            if turn <= last[to]:
                size[start] -= rows
                size[to] += rows
        full = [j for j in range(n) if size[j] > max(quotas[j], held[j]) and last[j] >= 0]
        if not full:
            return last
        for j in full:
            over = size[j] - max(quotas[j], held[j])
            for turn in sorted((t for t in into[j] if t <= last[j]), reverse=True):
                over -= into[j][turn]
                last[j] = turn - 1
                if over <= 0:
                    break
            else:
                last[j] = -1


def propagate(labels: DataFrame, links: DataFrame, quotas: list[int], rounds: int = ROUNDS) -> tuple[DataFrame, list[float]]:
    """Move labels (node, weight, label) along ``links`` (node, hub, salt) under ``quotas`` of rows.

    Returns (node, weight, label, anchor, united) and the cut edges before each round. ``united``
    says that all neighbours carry the node's label. Every node has at least one link; a node
    occurs once in ``labels`` and once per hub in ``links``."""
    n = len(quotas)
    held, cuts = None, []
    for turn in range(rounds + 1):
        heard = _heard(labels, links, n).withColumn("all", F.aggregate("votes", F.lit(0).cast("long"), lambda a, x: a + x))
        # the first round's labels are all about to move: any shard may have room
        free = F.array(*[F.lit(q if held is None else max(q - h, 0)) for q, h in zip(quotas, held or quotas, strict=True)])
        score = F.transform("votes", lambda c, j: F.when(
            (F.col("all") - c <= free[j]) & ((c > 0) | F.lit(turn >= 2)),
            c * 64 + F.pmod(F.xxhash64("anchor", j), F.lit(64))).otherwise(F.lit(-1)))
        wish = heard.withColumn("score", score).withColumn("best", F.array_max("score"))
        wish = wish.withColumn("to", F.when(F.col("best") >= 0, F.array_position("score", F.col("best")) - 1)
                               .otherwise(F.col("label")).cast("int"))
        wish = wish.withColumn("turn", F.when(F.col("to") != F.col("label"), (
            (F.lit(62) - F.floor(F.log2("all"))) * TURNS + F.pmod(F.xxhash64("anchor", F.lit(turn)), F.lit(TURNS))).cast("int")))
        wish = wish.withColumn("cut", F.col("all") - F.col("votes")[F.col("label")])
        wish = written(wish.select("node", "weight", "label", "anchor", "cut", "to", "turn"), "shard-wishes")
        # at most shards * shards * powers of two * TURNS rows
        counts = wish.groupBy("label", "to", "turn").agg(
            F.sum("weight").alias("rows"), F.sum(F.col("weight").cast("double") * F.col("cut")).alias("cut")).collect()
        cuts.append(sum(r.cut for r in counts) / 2)
        held = [sum(r.rows for r in counts if r.label == j) for j in range(n)]
        asked = [(r.label, r.to, r.turn, r.rows) for r in counts if r.turn is not None]
        last = _granted(asked, held, quotas)
        if turn == rounds or not any(t <= last[to] for _, to, t, _ in asked):
            break
        moves = F.coalesce(F.col("turn") <= F.array(*[F.lit(t) for t in last])[F.col("to")], F.lit(False))
        labels = wish.select("node", "weight", F.when(moves, F.col("to")).otherwise(F.col("label")).alias("label"))
        for start, to, t, rows in asked:
            if t <= last[to]:
                held[start] -= rows
                held[to] += rows
    return wish.select("node", "weight", "label", "anchor", (F.col("cut") == 0).alias("united")), cuts


def _fitting(placed: DataFrame, quotas: list[int]) -> tuple[DataFrame, list[int]]:
    """Nodes of united hubs, as many as the quotas hold, and the room that they leave. Only a shard that
    started above its quota has more than it holds."""
    placed = placed.where("united").withColumn("lot", F.pmod(F.xxhash64("anchor"), F.lit(256)).cast("int"))
    lots = placed.groupBy("label", "lot").agg(F.sum("weight").alias("rows")).collect()  # at most 256 a shard
    left, last = list(quotas), [256] * len(quotas)
    for r in sorted(lots, key=lambda r: (r.label, r.lot)):
        if last[r.label] == 256 and r.rows <= left[r.label]:
            left[r.label] -= r.rows
        else:
            last[r.label] = min(last[r.label], r.lot)
    kept = F.col("lot") < F.array(*[F.lit(t) for t in last])[F.col("label")]
    return placed.where(kept).select("node", F.col("label").alias("shard")), left


def shards(docs: DataFrame, n: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size is the UTF-8 bytes of the text plus 8. Every shard gets the floor or the ceiling of
    rows / n; slot counts from 0 within a shard without gaps. A null text counts as an empty one,
    and empty texts are equal texts. Repeated rows get a slot each. law is "rows", so grown_shard
    is null. An empty table gives an empty result; other columns are ignored.
    """
    rows = written(_rows(docs), "shard-rows")
    total = rows.count()
    quota = total // n
    buckets = max(64, min(1 << 16, total // 2000))
    salt = F.pmod(F.xxhash64("rid"), F.lit(max(16, min(1 << 12, total // CROWD)))).cast("int")
    rows = rows.withColumn("bucket", _bucket(buckets)).withColumn("salt", salt)

    sizes = (rows.groupBy(*KEY, "salt").agg(F.count("*").alias("here"))
             .groupBy(*KEY).agg(F.sum("here").alias("group_rows"), F.collect_set("salt").alias("salts")).where("group_rows > 1"))
    parts = F.ceil(F.col("group_rows") / max(1, quota // 4))
    hub = F.xxhash64(*KEY, F.pmod(F.xxhash64("bucket", "rid"), parts))
    tagged = rows.join(sizes.select(*KEY, "group_rows", F.explode("salts").alias("salt")), [*KEY, "salt"], "left")
    tagged = written(tagged.withColumn("hub", F.when(F.col("group_rows").isNotNull(), hub))
                     .withColumn("node", F.xxhash64("rid", *KEY)), "shard-nodes")
    nodes = tagged.where("hub IS NOT NULL").groupBy("node", "hub", "salt").agg(F.count("*").alias("weight"))
    start = F.pmod(F.xxhash64("node"), F.lit(n)).cast("int").alias("label")
    placed, _ = propagate(nodes.select("node", "weight", start), nodes.select("node", "hub", "salt"), [quota] * n, rounds)
    kept, left = _fitting(placed, [quota] * n)

    out = written(tagged.join(kept, "node", "left"), "shard-placed")
    # the rest fills what is left of each shard, group by group: shard j gets the ranks below edge j
    room = [r + (j < total % n) for j, r in enumerate(left)]
    edges = [sum(room[:j + 1]) for j in range(n)]
    lane = (F.pmod(F.xxhash64(F.coalesce("hub", "node")), F.lit(buckets)) * (1 << 12)
            + F.when(F.col("group_rows") > CROWD, F.col("salt")).otherwise(0))
    rest = _ranked(out.where("shard IS NULL").withColumn("bucket", lane), [], "rank")
    filled = F.coalesce(*[F.when(F.col("rank") < e, F.lit(j)) for j, e in enumerate(edges)])
    rest = rest.withColumn("shard", filled).drop("rank").withColumn("bucket", _bucket(buckets))
    every = out.where("shard IS NOT NULL").unionByName(rest)
    return _ranked(every, ["shard"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"))
