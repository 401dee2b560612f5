"""Source divergence audit: one-hot level products.

1. Every partition counts its terms by language and source; the counts are added by (lang, term), and a language keeps the
   terms that occur in at least LEAST of its documents.
2. The kept terms of a language are dealt into blocks of about TERMS, its sources into blocks of SOURCES. For a block of
   terms and a pair of source blocks, indicator columns say which terms stand at which count level of which source (level 0
   included). The product of one block's columns, transposed, with the other's is the joint table of every two sources'
   levels: how many terms stand at level a here and b there. It is made by exact matrix products over ROWS terms
   by COLUMNS columns at most.
3. Each cell of a joint table is priced once, by the divergence of its two levels' probabilities, and the prices are added
   by pair of sources. Terms of a language that a block pair doesn't meet stand at level 0 in both.

All numbers are whole: probabilities are billionths, rounded down, made with decimals; a product's cells are counts up to
ROWS, which a 32-bit float holds exactly.

A document is a row: null and repeated ids change nothing. Null text, lang and source count as ''. Texts of any length are
counted whole. A group without kept terms has the pairs of its language, all its levels being 0; where a language keeps
no term, its pairs have the value 0. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinflow.llm.common import by_value, cut, measured, text_or_empty

by_value(__name__)

#: Documents of a language that a kept term occurs in, and ranks of the term part.
LEAST, TOP = 10, 10
#: Terms and sources of a block; rows and columns of a matrix product; entries that a task counts before it hands them on.
TERMS, SOURCES, ROWS, COLUMNS, HELD = 1024, 64, 256, 2048, 300_000
#: Letters and what is not ASCII make terms; A-Z count as a-z.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
BILLION = 1_000_000_000


def terms(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs): occurrences and documents of each term in what a task has read; a term can come several times."""
    held: dict[tuple, tuple[Counter, Counter]] = {}

    def told() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            keys = list(n)
            columns = [pa.array([lang] * len(keys), pa.string()), pa.array([source] * len(keys), pa.string()), pa.array(keys, pa.binary()).view(pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(n.values()), pa.int64()), pa.array([docs[k] for k in keys], pa.int64())], ["lang", "source", "term", "n", "docs"])
        held.clear()

    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()), strict=True):
            found = terms(text.as_py())
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            n.update(found)
            docs.update(set(found))
        if sum(len(n) for n, _ in held.values()) > HELD:
            yield from told()
    yield from told()


def kept_terms(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, source, term, n, n_lang, first): counts of the terms that at least ``least`` documents of their language have; ``first`` is true
    for one row of each (lang, term). One exchange, by (lang, term), serves the sums and the windows."""
    rows = docs.select(*[text_or_empty(c).alias(c) for c in ("lang", "source", "text")])
    parts = rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long").repartition("lang", "term")
    cells = parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    cells = cells.select("*", F.sum("docs").over(term).alias("all"), F.sum("n").over(term).alias("n_lang"), (F.col("source") == F.min("source").over(term)).alias("first"))
    return cells.filter(F.col("all") >= least).select("lang", "source", "term", "n", "n_lang", "first")


def groups(docs: DataFrame, cells: DataFrame) -> DataFrame:
    """(lang, source, total, total_lang, v, place, n_groups): every group that occurs, with the sums of ``cells``, numbered within its language."""
    occurring = docs.select(text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source")).distinct()
    own = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.when(F.col("first"), 1)).alias("firsts"))
    rows = occurring.join(own, ["lang", "source"], "left").fillna(0, ["total", "firsts"])
    lang = Window.partitionBy("lang")  # as long as a row of the result has partners
    return rows.select("lang", "source", "total", F.sum("total").over(lang).alias("total_lang"), F.sum("firsts").over(lang).alias("v"), (F.row_number().over(lang.orderBy("source")) - 1).alias("place"), F.count(F.lit(1)).over(lang).alias("n_groups"))


def price(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 v)); decimals, since the product can be beyond 64 bits."""
    whole = F.greatest(total + 2 * v, F.lit(1)).cast("decimal(20,0)")
    return 1 + F.call_function("div", F.lit(BILLION).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)"), whole)


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); at most 10^18 before the division."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def joint_prices(level: np.ndarray, cost: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The prices of all joint tables between ``left`` and ``right`` sources, added by pair.

    ``level`` and ``cost`` (terms x sources): the count of each term in each source, and its probability."""
    out = np.zeros((len(left), len(right)), np.int64)
    rank = np.argsort(level.sum(1), kind="stable")  # terms of like counts share levels, so their block has few columns

    def indicators(at: np.ndarray, sources: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Blocks of indicator columns of some terms: the matrix, each column's source (by place) and probability."""
        counts, source = level[np.ix_(at, sources)], np.broadcast_to(np.arange(len(sources)), (len(at), len(sources)))
        keys = np.stack([source.ravel(), counts.ravel()])
        columns, one, where = np.unique(keys, axis=1, return_index=True, return_inverse=True)
        of_term, prices = np.repeat(np.arange(len(at)), len(sources)), cost[np.ix_(at, sources)].ravel()[one]
        where = where.ravel()
        for b in range(0, columns.shape[1], COLUMNS):
            some = (where >= b) & (where < b + COLUMNS)
            x = np.zeros((len(at), min(COLUMNS, columns.shape[1] - b)), np.float32)
            x[of_term[some], where[some] - b] = 1
            yield x, columns[0, b : b + COLUMNS], prices[b : b + COLUMNS]

    for b in range(0, len(rank), ROWS):
        at = rank[b : b + ROWS]
        for x, of_x, p in indicators(at, left):
            for y, of_y, q in indicators(at, right):
                joint = x.T @ y
                i, j = np.nonzero(joint)
                a, c = p[i], q[j]
                np.add.at(out, (of_x[i], of_y[j]), joint[i, j].astype(np.int64) * ((a - c) * (a - c) // (a + c)))
    return out


def _priced(block: pa.Table) -> pa.Table:
    """A block of terms and a pair of source blocks: (lang, a, b, value, met) for each two sources a < b."""
    names = ["lang", "a", "b", "value", "met"]
    place, n, p = (block.column(c).to_numpy() for c in ("place", "n", "p"))
    zero = n == 0  # one row a source, with the probability of level 0
    sources, at = np.unique(place[zero], return_index=True)
    at_zero = p[zero][at]
    term = block.column("term").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)[~zero]
    _, term = np.unique(term, return_inverse=True)
    met = int(term.max()) + 1 if len(term) else 0
    level, cost = np.zeros((met, len(sources)), np.int64), np.tile(at_zero, (met, 1))
    column = np.searchsorted(sources, place[~zero])
    level[term, column], cost[term, column] = n[~zero], p[~zero]
    i, j = block.column("i")[0].as_py(), block.column("j")[0].as_py()
    left, right = np.flatnonzero(sources // SOURCES == i), np.flatnonzero(sources // SOURCES == j)
    value = joint_prices(level, cost, left, right)
    x, y = np.nonzero(sources[left][:, None] < sources[right][None, :])
    columns = [pa.array(sources[left][x], pa.int64()), pa.array(sources[right][y], pa.int64()), pa.array(value[x, y], pa.int64()), pa.array(np.full(len(x), met), pa.int64())]
    return pa.Table.from_arrays([pa.array([block.column("lang")[0].as_py()] * len(x), pa.string()), *columns], names)


def pair_values(cells: DataFrame, facts: DataFrame) -> DataFrame:
    """(lang, source, item, value): every two sources of a language, both ways round. ``facts``: ``groups`` (cut)."""
    blocks = F.greatest(F.ceil(F.col("v") / TERMS), F.lit(1))
    known = facts.withColumns({"blocks": blocks, "own": F.floor(F.col("place") / SOURCES), "last": F.floor((F.col("n_groups") - 1) / SOURCES), "p0": price(F.lit(0).cast("long"), F.col("total"), F.col("v"))})
    small = measured(facts, rows=200_000)
    marked = F.broadcast(known) if small is not facts else known
    rows = cells.join(marked, ["lang", "source"]).select("lang", F.pmod(F.xxhash64("term"), "blocks").alias("block"), "own", "last", F.col("place").cast("long").alias("place"), "term", "n", price(F.col("n"), F.col("total"), F.col("v")).alias("p"))
    zeros = known.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "own", "last", F.col("place").cast("long").alias("place"), F.lit("").alias("term"), F.lit(0).cast("long").alias("n"), F.col("p0").alias("p"))
    both = rows.unionByName(zeros).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
    both = both.select("lang", "block", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "place", "term", "n", "p")
    found = both.groupBy("lang", "block", "i", "j").applyInArrow(_priced, "lang string, a long, b long, value long, met long")
    found = found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("met").alias("met"))
    side = lambda k: marked.select("lang", F.col("place").cast("long").alias(k), F.col("source").alias(f"source_{k}"), F.col("p0").alias(f"p_{k}"), F.col("v").alias(f"v_{k}"))
    found = found.join(side("a"), ["lang", "a"]).join(side("b"), ["lang", "b"])
    value = F.col("value") + (F.col("v_a") - F.col("met")) * divergence(F.col("p_a"), F.col("p_b"))
    ways = F.array(F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")), F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item")))
    return found.select("lang", value.alias("value"), F.explode(ways).alias("w")).select("lang", "w.source", "w.item", "value")


def term_values(cells: DataFrame, facts: DataFrame) -> DataFrame:
    """(lang, source, item, value): the terms that a group has relatively more of than its language."""
    own = measured(facts).select("lang", "source", "total", "total_lang", "v")
    p, q = price(F.col("n"), F.col("total"), F.col("v")), price(F.col("n_lang"), F.col("total_lang"), F.col("v"))
    rows = cells.join(own, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).filter("p > q")
    return rows.select("lang", "source", "item", divergence(F.col("p"), F.col("q")).alias("value"))


def source_divergence(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: part ``pair`` has each other source of the language, part ``term`` the ``top`` terms."""
    cells = cut(kept_terms(docs, least))
    facts = cut(groups(docs, cells))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pair_values(cells, facts).select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))
    best = term_values(cells, facts).select("lang", "source", F.lit("term").alias("part"), "item", "value", rank.alias("rank")).filter(F.col("rank") <= top)
    return pairs.unionByName(best)
