"""Benchmark decontamination with DataFrame functions alone.

The normalised word windows of the test items (``width`` words; an item of fewer is one window) are the broadcast set.
Before it, a document is looked at only every ``stride`` words: the ``gram`` words from there are hashed and held against
the hashes of the items' word sequences, for each size of windows by itself. A window that occurs in a document has such a
place among its first ``stride`` words, so only windows that start shortly before a place that was found are formed and
joined, as whole strings, with the set: each hit is verified by equality. Short items (of one word, say) so add hashes of
one size and no windows of others. Where the items are too many for the hashes to go with the plan (GRAMS), the
places' hashes are joined with the items' and what was found is joined back to the texts; where a side is too large for
a broadcast, the join is a shuffle join. Results are the same.

Null text has no words; an item without words has no window. The windows of an item with a null id count as hits, but it
can't be named and is not among the items found. Items of one id count once. Rows that repeat give a row each. An empty
table of documents gives an empty result, one of items gives no hit. Texts of any length are taken whole: places that no
item's hash names cost one hash each. Columns other than id and text are not read; what drops or cleans documents hands
them on, whatever their names.

What is found leaves with its document (drop_contaminated) or is taken out of it (remove_spans).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.llm.common import ascii_lower, cut, measured, own_columns, spare, text_or_empty

WIDTH, GRAM = 13, 4
#: Hashes of word sequences that go with the plan, and windows that are broadcast (about 100 bytes each), at most.
GRAMS, WINDOWS = 50_000, 300_000
#: Fixed value: a word.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words before A to Z are lowered.
CASED = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def item_windows(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """(w, size, items): each window as words joined by a space, its number of words, and the ids (strings, none that is null) of its items."""
    rows = items.select(F.col("item_id").cast("string").alias("item"), words_of(text_or_empty()).alias("ws"))
    rows = rows.filter(F.size("ws") > 0).withColumn("size", F.least(F.size("ws"), F.lit(width)))
    starts = F.sequence(F.lit(1), F.size("ws") - F.col("size") + 1)
    rows = rows.select("item", "size", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("ws", i, F.col("size")), " "))).alias("w"))
    return rows.groupBy("w", "size").agg(F.collect_set("item").alias("items"))


def _long(value: int) -> str:
    """A bigint literal; the smallest has none of its own."""
    return f"{value}L" if value != -(2**63) else "bigint(-9223372036854775808)"


def hits(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row for each row of ``docs``: doc_id, rid, n_words, spans (start, size of each occurrence), items (sorted strings)."""
    windows = cut(item_windows(items, width))
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # 13 numbers at most
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("rid"), words_of(text_or_empty()).alias("ws")).withColumn("n_words", F.size("ws").cast("long"))
    kind = "array<struct<at:int,size:int,w:string>>"
    formed = F.lit(None).cast(kind)
    if sizes:
        # each size has its own sequences and stride, so that a short item asks for more places of its own size alone
        grams, strides = {n: min(GRAM, n) for n in sizes}, {n: n - min(GRAM, n) + 1 for n in sizes}
        gram = F.least(F.col("size"), F.lit(GRAM))
        parts = F.explode(F.transform(F.sequence(F.lit(0), F.col("size") - gram), lambda i: F.slice(F.split("w", " "), i + 1, gram))).alias("g")
        hashes = windows.select("size", parts).select("size", F.xxhash64("g").alias("h")).distinct()
        known = hashes.limit(GRAMS + 1).collect()  # a row more than GRAMS at most
        each = {n: f"if(n_words >= {n}, sequence(0, n_words - {grams[n]}, {strides[n]}), cast(array() as array<bigint>))" for n in sizes}
        if len(known) > GRAMS:
            # the places go to the hashes: a long for each, ten words apart, and back come those of the places that were found
            rows = rows.withColumn("key", F.sha2(F.array_join("ws", " "), 256))
            asked = ", ".join(f"transform({each[n]}, p -> struct({n} as size, p, xxhash64(slice(ws, cast(p + 1 as int), {grams[n]})) as h))" for n in sizes)
            looked = rows.select("key", F.explode(F.expr(f"concat({asked})")).alias("x")).select("key", "x.*")
            near = looked.join(measured(cut(hashes)), ["size", "h"], "left_semi").groupBy("key").agg(F.collect_set(F.struct("size", "p")).alias("near"))
            rows = rows.join(measured(cut(near)), "key", "left")
            each = {n: f"transform(filter(coalesce(near, cast(array() as array<struct<size:int,p:bigint>>)), x -> x.size = {n}), x -> x.p)" for n in sizes}
        else:
            said = {n: ", ".join(_long(r["h"]) for r in known if r["size"] == n) for n in sizes}
            each = {n: f"filter({each[n]}, p -> xxhash64(slice(ws, cast(p + 1 as int), {grams[n]})) in ({said[n]}))" for n in sizes}
        # a place is among the first ``stride`` words of the windows that it may be in
        own = [
            f"flatten(transform({each[n]}, p -> transform(sequence(greatest(p - {strides[n] - 1}, 0), least(p, n_words - {n})), "
            f"s -> struct(cast(s as int) as at, {n} as size, array_join(slice(ws, cast(s + 1 as int), {n}), ' ') as w))))"
            for n in sizes
        ]
        formed = F.expr(f"concat({', '.join(own)})").cast(kind)
    none = F.array(F.lit(None).cast("struct<at:int,size:int,w:string>"))
    rows = rows.select("doc_id", "rid", "n_words", F.explode(F.concat(none, F.coalesce(formed, F.array().cast(kind)))).alias("x")).select("doc_id", "rid", "n_words", "x.at", "x.size", "x.w")
    found = rows.join(measured(windows.select("w", "items"), WINDOWS), "w", "left").filter("w is null or items is not null")
    return found.groupBy("doc_id", "rid", "n_words").agg(
        F.array_sort(F.collect_list(F.when(F.col("items").isNotNull(), F.struct("at", "size")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )


def covered(spans: Column) -> Column:
    """How many words lie inside a span; ``spans`` are sorted by start."""
    begin = F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n"))

    def add(a: Column, x: Column) -> Column:
        end = x["at"] + x["size"]
        return F.struct(F.greatest(a["to"], end).alias("to"), (a["n"] + F.greatest(end - F.greatest(a["to"], x["at"]), F.lit(0))).alias("n"))

    return F.aggregate(spans, begin, add)["n"]


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated (a twentieth of the words or more lie in windows of test items)."""
    found = hits(docs, items, width).withColumn("n_hit", covered(F.col("spans")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` without the contaminated ones; same columns. A text that several rows have is judged once."""
    text = text_or_empty()
    # word-for-word equal texts are judged alike, so the decision travels by a digest of the text
    judged = docs.select(F.sha2(text, 256).alias("doc_id"), F.col("text"))
    (sha,) = spare(docs, "sha")
    bad = cut(hits(judged, items, width).withColumn("n_hit", covered(F.col("spans"))).filter("n_hit > 0 and 20 * n_hit >= n_words").select(F.col("doc_id").alias(sha)).distinct())
    return docs.withColumn(sha, F.sha2(text, 256)).join(measured(bad, WINDOWS), sha, "left_anti").select(*own_columns(docs))


def merged(spans: Column) -> Column:
    """array of (a, b): spans sorted by start as ranges of words, b exclusive; those that touch or overlap are one."""
    begin = F.array().cast("array<struct<a:int,b:int>>")

    def add(done: Column, x: Column) -> Column:
        last, end = F.try_element_at(done, F.lit(-1)), x["at"] + x["size"]
        longer = F.struct(last["a"].alias("a"), F.greatest(last["b"], end).alias("b"))
        grown = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer))
        return F.when(F.coalesce(last["b"] >= x["at"], F.lit(False)), grown).otherwise(F.concat(done, F.array(F.struct(x["at"].alias("a"), end.alias("b")))))

    return F.aggregate(spans, begin, add)


def without(text: Column, ranges: Column) -> Column:
    """``text`` without the words in sorted ranges that don't touch; what stands before such a word goes with it."""
    words, gaps = F.regexp_extract_all(text, F.lit(CASED), F.lit(0)), F.split(text, CASED, -1)
    units = F.zip_with(F.slice(gaps, F.lit(1), F.size(words)), words, lambda gap, word: F.concat(gap, word))
    starts = F.concat(F.array(F.lit(0)), F.transform(ranges, lambda r: r["b"]))
    ends = F.concat(F.transform(ranges, lambda r: r["a"]), F.array(F.size(words)))
    kept = F.zip_with(starts, ends, lambda a, b: F.array_join(F.slice(units, a + 1, b - a), ""))
    return F.concat(F.array_join(kept, ""), F.element_at(gaps, -1))


def remove_spans(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with the words inside windows of test items taken out of ``text``; same rows and columns, a null text stays null."""
    text = text_or_empty()
    judged = docs.select(F.sha2(text, 256).alias("doc_id"), F.col("text"))
    sha, ranges = spare(docs, "sha", "ranges")
    found = hits(judged, items, width).filter("size(spans) > 0").select(F.col("doc_id").alias(sha), merged(F.col("spans")).alias(ranges))
    found = cut(found.groupBy(sha).agg(F.first(ranges).alias(ranges)))  # equal texts have equal ranges
    rows = docs.withColumn(sha, F.sha2(text, 256)).join(measured(found, WINDOWS), sha, "left")
    clean = F.when(F.col(ranges).isNull(), F.col("text")).otherwise(without(F.col("text"), F.col(ranges))).alias("text")
    return rows.select(*[clean if c == "text" else x for c, x in zip(docs.columns, own_columns(docs), strict=True)])
