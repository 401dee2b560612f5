"""Quality classifier by hierarchical empirical Bayes.

A logistic classifier on a text's hashed words and on ratios of its form gives each document its evidence p. Sites
(``source``) and paths in them (``source`` and ``lang``; the tables have no URL) have posterior means of p: a site's shrinks
towards the global mean, a path's towards its site's, the more the fewer documents it has; how strongly is estimated from
the spread between sites and between paths (method of moments, from grouped sums over all documents). A document's quality
is its evidence moved by the log odds of its path's posterior against the global mean; its own evidence is left out of
that posterior, so it counts once. Each text is looked at once: p is kept and joined with the groups' sums.

The classifier is fitted on LABELLED labelled documents at most, taken in the order of a hash of the id (of rows of one id,
of a hash of the text). Without labels of both kinds every document's p is 0.5 and all are kept. Null text is empty; a null
site or language is a site or language of its own. Texts of any length are taken whole. Rows that repeat give a row each;
an empty table gives an empty result; other columns are not read, and keep_good hands them on, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.llm.common import by_value, cut, lean, measured, own_columns, scratch, spare, text_or_empty
from clinflow.llm.shingles import Shingler

by_value(__name__)

LABELLED, THRESHOLD = 6_000, 0.5
#: Buckets of hashed words, and how much their weights are held towards zero (the ratios' weights: 1).
BUCKETS, RIDGE = 256, 50.0
RATIOS = 7


def vectors(texts: list[str]) -> np.ndarray:
    """A row for each text: shares of marks, capitals and digits, of distinct words and lines, word length, length; then the hashed words' shares."""
    shingler = Shingler(1)
    kinds = np.zeros((3, 256), bool)
    for row, chars in zip(kinds, (b"!#$%&*|~^<>{}=", bytes(range(65, 91)), bytes(range(48, 58))), strict=True):
        row[list(chars)] = True
    out = np.zeros((len(texts), RATIOS + BUCKETS), np.float32)
    for row, text, words in zip(out, texts, shingler.words_of(texts), strict=True):
        of_byte = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
        n, k, lines = max(1, len(text)), max(1, len(words)), text.split("\n")
        row[:3] = kinds @ of_byte / n
        row[3:RATIOS] = len(np.unique(words)) / k, len(set(lines)) / len(lines), n / k, np.log1p(n)
        row[RATIOS:] = np.sqrt(np.bincount((words % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS) / k)
    return out


def _blocks(texts: list[str], size: int = 1 << 20) -> Iterator[list[str]]:
    block, held = [], 0
    for text in texts:
        block.append(text)
        held += len(text)
        if held >= size or len(block) == 256:
            yield block
            block, held = [], 0
    if block:
        yield block


def _of_all(texts: pd.Series) -> Iterator[np.ndarray]:
    for block in _blocks(texts.tolist()):
        yield vectors(block)


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> np.ndarray | None:
    """Means, scales and weights (the last one the constant) of the logistic classifier, by Newton's method on a bounded sample."""
    sample = labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").cast("double").alias("y"))
    sample = F.broadcast(sample.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled))

    @F.pandas_udf("binary")
    def packed(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            yield pd.Series([x.tobytes() for part in _of_all(series) for x in part], dtype=object)

    rows = docs.select("doc_id", text_or_empty().alias("t")).join(sample, "doc_id")
    rows = rows.select("doc_id", F.xxhash64("t").alias("h"), "y", packed("t").alias("x")).orderBy(F.xxhash64("doc_id"), "doc_id", "h").limit(labelled).select("y", "x").toArrow()
    y = rows.column("y").to_numpy()
    if len(set(y.tolist())) < 2:
        return None
    x = np.stack([np.frombuffer(v.as_buffer(), np.float32) for v in rows.column("x")]).astype(np.float64)
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w, keep = np.zeros(z.shape[1]), np.array([1.0] * RATIOS + [RIDGE] * BUCKETS + [1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(keep), z.T @ (y - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return np.stack([np.append(mean, 0.0), np.append(scale, 1.0), w])


def evidence(text: Column, model: np.ndarray | None) -> Column:
    if model is None:
        return F.lit(0.5)
    mean, scale, w = model
    weights, constant = w[:-1] / scale[:-1], float(w[-1] - (mean * w / scale)[:-1].sum())

    @F.pandas_udf("double")
    def p(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            score = np.concatenate([x @ weights + constant for x in _of_all(series)]) if len(series) else np.zeros(0)
            yield pd.Series(1 / (1 + np.exp(-np.clip(score, -30, 30))))

    return p(text)


def _strength(groups: DataFrame, mean: str) -> float:
    """Documents that the prior counts for, from how far the groups' means spread beyond what their sizes explain."""
    spread = groups.select(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col(mean), 2)).alias("between"),
        F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n")).alias("within"),
    ).first()
    k, n = spread["k"] or 0, spread["n"] or 0
    if k < 2 or n <= k:
        return 10.0
    inside = max(spread["within"], 0.0) / (n - k)
    beyond = max((spread["between"] - (k - 1) * inside) / n, 1e-6)
    return min(max(inside / beyond, 1.0), 1e6)


def posteriors(scored: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """(site, path, s, n, s_site, n_site): sums of p and counts of all paths and of their sites; then the sums of all and the
    strengths of the two priors. ``scored`` has site, path and p."""
    paths = cut(scored.groupBy("site", "path").agg(F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("q"), F.count(F.lit(1)).alias("n")))
    total = paths.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    mean = total["s"] / total["n"] if total["n"] else 0.5
    sites = paths.groupBy("site").agg(F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum("n").alias("n")).withColumn("m", F.lit(mean))
    of_site = _strength(sites, "m")
    sites = sites.select("site", F.col("s").alias("s_site"), F.col("n").alias("n_site"), ((F.col("s") + of_site * mean) / (F.col("n") + of_site)).alias("p_site"))
    paths = cut(paths.join(sites, "site"))
    of_path = _strength(paths, "p_site")
    return paths.select("site", "path", "s", "n", "s_site", "n_site"), {"s": total["s"] or 0.0, "n": total["n"] or 0, "site": of_site, "path": of_path}


def _odds(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def _judged(rows: DataFrame, names: list[str], known: bool, threshold: float) -> tuple[DataFrame, dict[str, Column]]:
    """``rows`` (cut; ``names``: its columns of site, path and p, and unused names for four sums) with the sums, and the values made of them."""
    site, path, p, *sums = names
    table, all_ = posteriors(rows.select(F.col(site).alias("site"), F.col(path).alias("path"), F.col(p).alias("p")))
    table = table.select(F.col("site").alias(site), F.col("path").alias(path), *[F.col(a).alias(b) for a, b in zip(("s", "n", "s_site", "n_site"), sums, strict=True)])
    joined = rows.join(measured(cut(table)), [site, path], "left")
    own, (s, n, s_site, n_site) = F.col(p), map(F.col, sums)
    mean = (F.lit(all_["s"]) - own) / (all_["n"] - 1) if all_["n"] > 1 else F.lit(0.5)
    p_site = (s_site - own + all_["site"] * mean) / (n_site - 1 + all_["site"])
    p_path = (s - own + all_["path"] * p_site) / (n - 1 + all_["path"])
    quality = 1 / (1 + F.exp(-(_odds(own) + _odds(p_path) - _odds(mean)))) if known else F.lit(0.5)
    return joined, {"p_site": p_site, "p_path": p_path, "p_quality": quality, "keep": quality >= threshold}


def _named(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, Column], list[str], bool]:
    """Columns of site, path and p for ``docs``, their names and four more that ``docs`` doesn't have, and whether there is a classifier."""
    model = fit(lean(docs), labels)
    names = spare(docs, "site", "path", "p", "s", "n", "s_site", "n_site")
    own = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("\x00"))
    return dict(zip(names[:3], (own("source"), own("lang"), evidence(text_or_empty(), model)), strict=True)), names, model is not None


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, p_document, p_site, p_path, p_quality, keep."""
    columns, names, known = _named(docs, labels)
    joined, values = _judged(cut(docs.select("doc_id", *[v.alias(k) for k, v in columns.items()])), names, known, threshold)
    return joined.select("doc_id", F.col(names[2]).alias("p_document"), *[v.alias(k) for k, v in values.items()])


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without what the classifier rejects; same columns. The scored documents are written once to the shared folder, so that no text is scored again."""
    columns, names, known = _named(docs, labels)
    path = scratch(docs.sparkSession, "scored")
    docs.withColumns(columns).write.parquet(path)
    joined, values = _judged(docs.sparkSession.read.parquet(path), names, known, threshold)
    return joined.filter(values["keep"]).select(*own_columns(docs))
