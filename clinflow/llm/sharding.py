"""Sharding by balanced label propagation.

Documents with equal texts are linked. A document's label is a shard; at first it is dealt by a hash of the row. In each
round a Spark join tells every group's members where their neighbours are, and those outside the group's best shards (one,
or as many as the group needs room for) ask to move there. A shard takes what its quota allows: its free room and what
leaves it. Members of a group that have one label move together, so a group is not torn by a quota; a part that is large
beside a shard moves by shares. What is kept between rounds is one row for each group and label, so a group of any size is
a few rows.

The labels decide the shards (law ``rows``): a shard's linked members take its first slots, texts without a link fill the
room that is left, and only what a label has beyond its shard's size, the members last in its order, moves to shards with
room. Sizes differ by one at most, exactly.

Null text has 0 bytes (size 1) and is equal to empty text; null ids come first; rows equal in id and text get a slot
each. Texts of any length are one row with a digest here. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.llm.common import cut, measured, shuffle_partitions, text_or_empty

#: Rounds end early when no member asks to move or fewer than a thousandth of the linked ones would.
SHARDS, ROUNDS = 16, 8


def _unit(*cols: str | Column) -> Column:
    """A repeatable number in [0, 1)."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def spread(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(g, n) to (g, shard, n): every group dealt evenly over the shards, as a hash of the rows would."""
    at = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    share = F.col("n") + F.pmod(F.col("shard") - F.xxhash64("g"), F.lit(shards))
    return groups.select("g", "n", at).select("g", "shard", F.floor(share / shards).alias("n")).filter("n > 0")


def propagate(state: DataFrame, room: float, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(g, shard, n) to (g, shard, n): where each group's members end. ``room``: members that a shard takes."""
    room = max(room, 1.0)
    for k in range(rounds):
        load = {r["shard"]: float(r["n"]) for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}  # one row a shard
        free = [max(0.0, room - load.get(s, 0.0)) for s in range(shards)]
        # after two rounds those that are still apart meet where room is, if one of their shards has any
        roomy = F.col("shard").isin(*[s for s in range(shards) if free[s] >= 1 and k > 1]).alias("roomy")
        places = F.reverse(F.array_sort(F.collect_list(F.struct(roomy, "n", F.xxhash64("g", "shard").alias("h"), "shard"))))  # a row a shard at most
        best = state.groupBy("g").agg(places.alias("p"), F.sum("n").alias("all"))
        best = best.select("g", F.transform(F.slice("p", F.lit(1), F.ceil(F.col("all") / room).cast("int")), lambda x: x["shard"]).alias("best"))
        to = F.when(F.array_contains("best", F.col("shard")), F.col("shard")).otherwise(F.element_at("best", F.pmod(F.xxhash64("g", "shard"), F.size("best")).cast("int") + 1))
        wish = cut(state.join(best, "g").select("g", "shard", "n", to.alias("to")))
        wanted = {(r["shard"], r["to"]): float(r["n"]) for r in wish.filter("shard <> to").groupBy("shard", "to").agg(F.sum("n").alias("n")).collect()}  # shards squared
        part = quotas(free, wanted)
        if not wanted or 1000 * sum(n * part[b] for (_, b), n in wanted.items()) < sum(load.values()):
            break
        share = F.element_at(F.array(*map(F.lit, part)), F.col("to") + 1)
        chance = _unit("g", "shard", F.lit(k))  # quotas hold on average
        moved = F.when(F.col("n") * 64 <= room, F.when(chance < share, F.col("n")).otherwise(0)).otherwise(F.least("n", F.floor(F.col("n") * share + chance)))
        moves = wish.withColumn("moved", F.when(F.col("shard") == F.col("to"), 0).otherwise(moved))
        parts = F.inline(F.array(F.struct("shard", (F.col("n") - F.col("moved")).alias("n")), F.struct(F.col("to").alias("shard"), F.col("moved").alias("n"))))
        state = cut(moves.select("g", parts).filter("n > 0").groupBy("g", "shard").agg(F.sum("n").alias("n")))
    return state


def quotas(free: list[float], wanted: dict[tuple[int, int], float]) -> list[float]:
    """For each shard the share of the moves towards it that it takes: all, or what its free room and the moves out of it allow."""
    part = [1.0] * len(free)
    for _ in range(100):
        for s in range(len(free)):
            come = sum(n for (_, b), n in wanted.items() if b == s)
            go = sum(n * part[b] for (a, b), n in wanted.items() if a == s)
            part[s] = min(part[s], (free[s] + go) / come) if come else 1.0
    return part


def outside(state: DataFrame) -> int:
    """Linked members that are not in the shard that holds most of their group: each of them is cut off."""
    return state.groupBy("g").agg((F.sum("n") - F.max("n")).alias("n")).agg(F.sum("n")).first()[0] or 0


def _starts(sizes: list[int]) -> list[int]:
    out = [0]
    for x in sizes:
        out.append(out[-1] + x)
    return out


def _pick(values: list[int], by: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), by + 1)


def _indexed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``i``, their place in the order of ``keys``, from a range partitioning and one count a partition."""
    order = cut(rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys))
    order = order.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33).cast("int"))
    counts = dict(order.groupBy("part").count().collect())  # one row a partition
    first, offsets = 0, []
    for p in sorted(counts):
        offsets.append((p, first))
        first += counts[p]
    starts = rows.sparkSession.createDataFrame(offsets, "part int, first long")
    return order.join(F.broadcast(starts), "part").withColumn("i", F.col("first") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("at", "part", "first")


def shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHARDS) -> DataFrame:
    """One row for each row of ``docs``: id, size, text_crc32, law, shard, slot, grown_shard."""
    t = text_or_empty(text_col)
    size = F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long") + 1
    rows = cut(docs.select(F.col(id_col).alias("id"), size.alias("size"), F.crc32(t.cast("binary")).alias("crc"), F.unhex(F.sha2(t, 256)).alias("g"), F.monotonically_increasing_id().alias("rid")))
    total = rows.count()
    groups = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    ends = propagate(cut(spread(groups, n)), total / n, n)
    # a group's labels as bounds of a hash of the row
    sums = cut(ends.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("at"), F.sum("n").alias("all")))
    begin = F.struct(F.lit(None).cast("int").alias("shard"), F.lit(0).cast("long").alias("to"))
    pick = F.aggregate("at", begin, lambda a, x: F.when(a["to"] > _unit("id", "rid") * F.col("all"), a).otherwise(F.struct(x["shard"].alias("shard"), (a["to"] + x["n"]).alias("to"))))
    placed = rows.join(measured(sums), "g", "left")
    placed = placed.select("id", "size", "crc", "rid", F.when(F.col("all").isNotNull(), F.col("g")).alias("g"), F.coalesce(pick["shard"], F.lit(n)).alias("label"), F.coalesce(-F.col("all"), F.lit(0)).alias("most"))
    # linked members by label, large groups first; texts without a link after them all (label n)
    index = cut(_indexed(placed, ["label", "most", "g", "id", "rid"]).select("id", "size", "crc", "label", "i"))
    linked = {r["label"]: r["count"] for r in index.groupBy("label").count().collect()}  # one row a shard
    loads = [linked.get(s, 0) for s in range(n)]
    sizes = [total // n + (s < total % n) for s in range(n)]
    over, room = [max(0, a - b) for a, b in zip(loads, sizes, strict=True)], [max(0, b - a) for a, b in zip(loads, sizes, strict=True)]
    before, over_before, room_before = _starts(loads), _starts(over), _starts(room)
    place = F.col("i") - _pick(before, F.col("label"))
    stays = (F.col("label") < n) & (place < _pick([*sizes, 0], F.col("label")))
    # what doesn't stay, in its order, goes where room is: first the surplus of the labels, then texts without a link
    q = _pick(over_before, F.col("label")) + place - F.when(F.col("label") < n, _pick([*sizes, 0], F.col("label"))).otherwise(0)
    target = F.lit(n - 1)
    for s in reversed(range(n - 1)):
        target = F.when(F.col("q") < room_before[s + 1], s).otherwise(target)
    index = index.select("id", "size", "crc", "label", place.alias("place"), stays.alias("stays"), q.alias("q"))
    index = index.withColumn("shard", F.when(F.col("stays"), F.col("label")).otherwise(target).cast("int"))
    taken = _pick([min(a, b) for a, b in zip(loads, sizes, strict=True)], F.col("shard"))
    slot = F.when(F.col("stays"), F.col("place")).otherwise(taken + F.col("q") - _pick(room_before[:n], F.col("shard")))
    return index.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), "shard", slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
