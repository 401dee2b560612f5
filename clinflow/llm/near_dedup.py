"""Near-duplicates by MinHash with tensored banding.

Two collections of M half keys (T minima each) are computed for a text, 2 M T minima in all; each pair of a half key of
the first and one of the second collection is the key of one of M x M tables. Texts with similarity s share a table with
probability (1 - (1 - s^T)^M)^2: with M = 9 and T = 2 that is 0.9998 at 0.8.

Texts with equal shingle sets are one node. The leader of a bucket is the node that meets most nodes in all tables; a
leader's canopy is the nodes of the buckets that it leads, so two nodes of a bucket have a canopy in common. A canopy is
dealt into parts of bounded size, each with the leader: there nodes are held against each other on their full sets, except
those that are linked already through others, and only what links them goes on. Components are found by contraction in
Spark joins. Where a canopy's parts lie in several components then, the nodes outside its largest component meet every
part, so no pair of different components is left out. A family of near copies above the threshold costs its size; only a
family that is mostly below it costs the square of the nodes that no link connects, in tasks of bounded memory.

Words and shingles are compared by 64-bit hashes (a word's bytes count by a hash of byte and place, so no rolling sum that
texts could be made to collide in), sets by 128 bits.

Texts without words have no shingle and are linked with nothing. Null text is such a text. Texts of any length are taken
whole. A null id takes part in links; a component's id is its smallest id (null if it has none). Rows that repeat, or
share a shingle set, are in one component. An empty table gives an empty result; other columns are not read, and
drop_near_copies hands them on, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.llm.common import by_value, cut, lean, measured, own_columns, spare, text_or_empty
from clinflow.llm.shingles import MinHash, Shingler

by_value(__name__)

M, T = 9, 2
#: Nodes of a canopy in a part, and their shingles (8 bytes each), about; a larger set is a part with few others.
BLOCK, SHINGLES = 192, 1 << 20
#: Rows (two longs each) that a broadcast side may have here, and edges that a task works on, about.
KEYS, EDGES = 2_000_000, 250_000


def _signatures(width: int, m: int, t: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, minhash = Shingler(width), MinHash(m, t)
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                sets = list(shingler.sets(batch.column(1).to_pylist()))
                full = [i for i, x in enumerate(sets) if len(x)]
                k1, k2, keys = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64), np.zeros((len(sets), 2 * m), np.uint64)
                if full:
                    k1[full], k2[full] = MinHash.names([sets[i] for i in full])
                    keys[full] = minhash.halves([sets[i] for i in full])
                lists = pa.FixedSizeListArray.from_arrays(pa.array(keys.view(np.int64).ravel()), 2 * m).cast(pa.list_(pa.int64()))
                further = batch.schema.names[2:]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array([len(x) for x in sets], np.int64)), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), lists, *batch.columns[2:]], names=["doc_id", "n", "k1", "k2", "halves", *further])

    return run


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                sets = [x for x in shingler.sets(whole.column(0).slice(at, 64).to_pylist()) if len(x)]
                if not sets:
                    continue
                k1, k2 = MinHash.names(sets)
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), lists], names=["k1", "k2", "set"])

    return run


def _keys(m: int) -> Column:
    """The M x M table keys of a node."""
    first, second = F.sequence(F.lit(1), F.lit(m)), F.sequence(F.lit(m + 1), F.lit(2 * m))
    return F.flatten(F.transform(first, lambda i: F.transform(second, lambda j: F.xxhash64(i, j, F.element_at("halves", i), F.element_at("halves", j)))))


def components(edges: DataFrame) -> DataFrame:
    """(x, y) to (node, label): each node of an edge with one node, the label, of what it is connected with.

    In a round every node points at its smallest neighbour, if that is smaller; pointers are doubled until each leads to a
    root, and what hangs on a root becomes one node. A chain of n nodes in order needs log2(n) doublings of one round.
    """
    edges = cut(edges.filter("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct())
    n = edges.count()
    # tasks by the number of edges, which is small against the documents: a short list is not dealt to every partition
    tight = lambda df: cut(df.coalesce(max(8, math.ceil(n / EDGES))))
    labels = tight(edges.select(F.explode(F.array("x", "y")).alias("node")).distinct().withColumn("label", F.col("node")))
    edges = tight(edges)
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        to = tight(both.groupBy("x").agg(F.min("y").alias("p")).select("x", F.least("x", "p").alias("p")))
        moving = True
        while moving:
            up = to.select(F.col("x").alias("p"), F.col("p").alias("q"))
            further = tight(to.join(up, "p").select("x", F.col("q").alias("p"), (F.col("p") != F.col("q")).alias("moved")))
            moving = not further.filter("moved").isEmpty()
            to = further.select("x", "p")
        labels = tight(labels.join(to.select(F.col("x").alias("label"), "p"), "label", "left").select("node", F.coalesce("p", "label").alias("label")))
        a, b = to.select("x", F.col("p").alias("px")), to.select(F.col("x").alias("y"), F.col("p").alias("py"))
        moved = edges.join(a, "x").join(b, "y").select(F.greatest("px", "py").alias("x"), F.least("px", "py").alias("y"))
        edges = tight(moved.filter("x <> y").distinct())
    return labels


def _links(nodes: np.ndarray, sets: list[np.ndarray], percent: int, label: np.ndarray, first: np.ndarray, second: np.ndarray) -> list[tuple[int, int]]:
    """(node, smallest node of its component) of what is linked, where every pair of one in ``first`` and one in ``second``
    (both may be the same) with different labels has been held against each other."""
    size = np.array([len(x) for x in sets])
    start = label.copy()
    label = label.copy()
    for p in np.flatnonzero(first):
        others = np.flatnonzero(second & (label != label[p]) & (100 * np.minimum(size, size[p]) >= percent * np.maximum(size, size[p])))
        if first is second:
            others = others[others > p]
        if not len(others):
            continue
        flat = np.concatenate([sets[i] for i in others])
        at = np.minimum(np.searchsorted(sets[p], flat), size[p] - 1)
        common = np.add.reduceat(sets[p][at] == flat, np.cumsum([0, *size[others[:-1]]]), dtype=np.int64)
        near = others[100 * common >= percent * (size[others] + size[p] - common)]
        if len(near):
            label[np.isin(label, label[near])] = label[p]
    least = {k: int(nodes[label == k].min()) for k in np.unique(label[label != start]).tolist()}
    return [(int(x), least[k]) for x, k in zip(nodes, label.tolist(), strict=True) if k in least and least[k] != x]


def _verify(percent: int):
    """Links inside a part of a canopy."""

    def run(group: pa.Table) -> pa.Table:
        nodes = group.column("node").to_numpy()
        sets = [x.values.to_numpy().view(np.uint64) for x in group.column("set")]  # sorted as unsigned numbers
        every = np.ones(len(nodes), bool)
        # the leader comes first: what is like it is linked at once, and only the others are held against each other
        order = np.argsort(nodes != group.column("lead")[0].as_py(), kind="stable")
        found = _links(nodes[order], [sets[i] for i in order], percent, np.arange(len(nodes)), every, every)
        return pa.table({"x": pa.array([a for a, _ in found], pa.int64()), "y": pa.array([b for _, b in found], pa.int64())})

    return run


def _verify_across(percent: int):
    """Links between some nodes of a canopy and those of a part of it."""

    def run(group: pa.Table) -> pa.Table:
        nodes, roamer = group.column("node").to_numpy(), group.column("roams").to_numpy(zero_copy_only=False)
        sets = [x.values.to_numpy().view(np.uint64) for x in group.column("set")]
        _, label = np.unique(group.column("label").to_numpy(), return_inverse=True)
        found = _links(nodes, sets, percent, label, roamer, ~roamer)
        return pa.table({"x": pa.array([a for a, _ in found], pa.int64()), "y": pa.array([b for _, b in found], pa.int64())})

    return run


def _parts(n: Column, size: Column) -> Column:
    """Parts of about BLOCK nodes and SHINGLES shingles."""
    return F.greatest(F.ceil(n / BLOCK), F.ceil(size / SHINGLES), F.lit(1)).cast("int")


def _linked(canopies: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, label) of the nodes with a link, by component; ``canopies``: lead, node, n; ``sets``: node, set.

    Canopies are dealt into parts of bounded size, each with the leader, and verified inside the parts. Where a canopy's
    parts then still lie in several components, the nodes outside its largest one (in blocks) meet every part.
    """
    one = F.count(F.lit(1))
    sizes = canopies.groupBy("lead").agg(_parts(one, F.sum("n")).alias("parts")).filter("parts > 1")
    many = measured(cut(sizes))  # canopies of one part need no row here, so this side is short and no leader is a join key of many rows
    dealt = canopies.join(many, "lead", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.hash("node"), F.col("parts"))
    everywhere = F.when(F.col("node") == F.col("lead"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own))
    placed = dealt.select("lead", "node", F.explode(everywhere).alias("part"))
    inside = cut(placed.join(sets, "node").groupBy("lead", "part").applyInArrow(_verify(percent), "x long, y long"))
    labels = components(inside)
    if many.isEmpty():
        return labels
    large = canopies.join(many, "lead").join(labels, "node", "left").select("lead", "node", "n", "parts", F.coalesce("label", "node").alias("label"))
    found = cut(large.groupBy("lead", "label").agg(one.alias("c"), F.sum("n").alias("n"), F.first("parts").alias("parts")))
    most = found.groupBy("lead").agg(F.max_by("label", F.struct("c", "label")).alias("most"), one.alias("labels")).filter("labels > 1")
    most = measured(cut(most))  # a row for a canopy of several parts: no canopy's labels meet in one task
    roaming = found.join(most, "lead").filter("label <> most").groupBy("lead").agg(_parts(F.sum("c"), F.sum("n")).alias("blocks"), F.first("most").alias("most"))
    roaming = measured(cut(roaming))
    if roaming.isEmpty():
        return labels
    large = cut(large.join(roaming, "lead"))
    block = F.pmod(F.hash("node", F.lit(1)), F.col("blocks"))
    stay = large.select("lead", "node", "label", F.lit(False).alias("roams"), F.pmod(F.hash("node"), F.col("parts")).alias("part"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    roam = large.filter("label <> most").select("lead", "node", "label", F.lit(True).alias("roams"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), block.alias("block"))
    across = stay.unionByName(roam.select(*stay.columns)).join(sets, "node").groupBy("lead", "part", "block").applyInArrow(_verify_across(percent), "x long, y long")
    # links across parts connect components of links inside them
    label_of = lambda end, name: labels.select(F.col("node").alias(end), F.col("label").alias(name))
    across = cut(across).join(label_of("x", "lx"), "x", "left").join(label_of("y", "ly"), "y", "left")
    above = components(across.select(F.coalesce("lx", "x").alias("x"), F.coalesce("ly", "y").alias("y")))
    alone = above.select(F.col("node"), "label").join(labels.select("node"), "node", "left_anti")
    lifted = labels.join(above.select(F.col("node").alias("label"), F.col("label").alias("higher")), "label", "left").select("node", F.coalesce("higher", "label").alias("label"))
    return lifted.unionByName(alone)


def _labelled(texts: DataFrame, width: int, percent: int, m: int, t: int, further: str = "") -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, k1, k2 and the further columns, for each row of ``texts``; label, id, k1, k2 of each shingle set: its component and its smallest id)."""
    signed = cut(lean(texts).mapInArrow(_signatures(width, m, t), f"doc_id long, n long, k1 long, k2 long, halves array<long>{further}"))
    nodes = signed.filter("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("halves").alias("halves"))
    nodes = cut(nodes).withColumn("node", F.monotonically_increasing_id())
    rows = nodes.select("node", F.explode(_keys(m)).alias("key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    buckets = cut(rows.join(measured(cut(shared), KEYS), "key"))
    meets = buckets.groupBy("node").agg(F.sum("c").alias("meets"))
    leads = buckets.join(meets, "node").groupBy("key").agg(F.max(F.struct("meets", "node"))["node"].alias("lead"))
    canopies = buckets.join(leads, "key").select("lead", "node").distinct().join(nodes.select("node", "n"), "node")
    canopies = cut(canopies.select("lead", "node", "n"))
    # full sets of the nodes that share a bucket, from the text of a document each
    inside = cut(canopies.select("node").distinct().join(nodes.select("node", "id", "k1", "k2"), "node"))
    wanted = measured(inside.select(F.col("id").alias("doc_id")))
    raw = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["doc_id"]), "left_semi").select("text").mapInArrow(_full_sets(width), "k1 long, k2 long, set array<long>")
    sets = cut(raw.join(inside, ["k1", "k2"]).dropDuplicates(["node"]).select("node", "set"))
    named = nodes.select("node", "id", "k1", "k2").join(_linked(canopies, sets, percent), "node", "left").withColumn("label", F.coalesce("label", "node"))
    return signed, cut(named.select("label", "id", "k1", "k2"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 2, percent: int = 80, m: int = M, t: int = T) -> DataFrame:
    """One row for each row of ``docs``: id, n_shingles, component_id, kept."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed, named = _labelled(texts, width, percent, m, t)
    # components of several sets, so that most sets, and a large component's, are in no join by label
    heads = named.groupBy("label").agg(F.min("id").alias("component_id"), F.count(F.lit(1)).alias("c")).filter("c > 1").select("label", "component_id")
    by_set = named.join(measured(cut(heads)), "label", "left").select("k1", "k2", F.coalesce("component_id", "id").alias("component_id"))
    full = signed.filter("n > 0").select("doc_id", "n", "k1", "k2").join(by_set, ["k1", "k2"])
    none = signed.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    out = full.select("doc_id", "n", "component_id").unionByName(none)
    return out.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(docs: DataFrame, width: int = 2, percent: int = 80, m: int = M, t: int = T) -> DataFrame:
    """``docs`` with one row of each component, and all rows without shingles; same columns.

    The row with the smallest id stays, a null id being the last; of equal ids the text with the smallest SHA-256. Ids may
    repeat or be null, so the decision travels by a digest of the text; of rows with the text that stays, one is chosen.
    """
    sha = F.sha2(text_or_empty(), 256)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), sha.alias("sha"))
    signed, named = _labelled(texts, width, percent, m, t, ", sha string")
    rows = cut(signed.filter("n > 0").select("doc_id", "sha", "k1", "k2").join(named.select("label", "k1", "k2"), ["k1", "k2"]).select("label", "sha", "doc_id"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "sha"))["sha"]
    groups = cut(rows.groupBy("label").agg(first.alias("stays"), F.count(F.lit(1)).alias("c")).filter("c > 1"))
    key, lost = spare(docs, "sha", "lost")
    found = rows.join(measured(groups.select("label", "stays")), "label").groupBy(F.col("sha").alias(key)).agg(F.max(F.col("sha") != F.col("stays")).alias(lost), F.count(F.lit(1)).alias("c"))
    found = cut(found.filter(F.col(lost) | (F.col("c") > 1)).select(key, lost))
    flagged = docs.withColumn(key, sha).join(measured(found), key, "left")
    names = own_columns(docs)
    alone = flagged.filter(F.col(lost).isNull()).select(*names)
    if found.filter(~F.col(lost)).isEmpty():
        return alone
    best = flagged.filter(~F.col(lost)).select(F.col(key).alias("key"), F.struct(*names).alias("row"), F.struct(F.col("doc_id").isNull(), "doc_id").alias("o"))
    return alone.unionByName(best.groupBy("key").agg(F.min_by("row", "o").alias("row")).select("row.*"))
