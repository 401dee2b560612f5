"""Personal data by scored candidates, with DataFrame functions alone.

Generators of high recall propose spans of several kinds, which may overlap. Each candidate has features of its form
(length, digits, separators, check digit, number ranges, issuer) and of its context (words before it, the characters
beside it). Gradient-boosted trees (MLlib) score it; the trees go into the plan as CASE expressions. For each kind the
threshold is the least score at and above which the held-out sample has the precision PRECISION. Base spans, which the
fixed rules accept, stay in any case. All other candidates, those of the base shapes that the rules refuse too, are added
if they pass and overlap no base span; of two added ones that overlap, from left to right, the one with the higher score stays.

The trees are fitted once, by ``fit``, and kept as SQL in pii_model.json; ``write_model`` makes that file anew. The fit's sample is bounded and
needs no corpus: PLANTED sentences, about half with a value of right form after fitting words, the others hard negatives (right form
after words for order, serial, version and part numbers, or a form that can't be: area codes and issuers that don't exist, wrong
check digits, spelled addresses without a name at the end); they pass through the same generators. Planted values of the
base kinds teach what refused ones look like. Candidates of a corpus can be added, QUOTA matches that the rules accept and QUOTA that
they refuse of each base kind. Held out are whole context words (every third of each kind), with all sentences that have them; a second
report is on words that neither the fit's sentences nor the features hold (``UNSEEN``).

Null text is empty and has no spans. Offsets count code points, the end is exclusive. Patterns are possessive, so texts of
any length are searched whole in linear time. Rows that repeat give a row each; an empty table gives an empty result;
other columns are not read; redacted hands them on, whatever their names.
"""

from __future__ import annotations

import json
import os
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflow.llm.common import cut, measured, own_columns, spare, text_or_empty

#: Matches of a base kind and verdict, planted sentences, trees and their depth, and the precision asked of each kind on held-out rows.
QUOTA, PLANTED, TREES, DEPTH, PRECISION = 400, 12_000, 8, 4, 0.99

#: Where the fitted trees are kept.
MODEL = os.path.join(os.path.dirname(os.path.abspath(__file__)), "pii_model.json")

#: The base kinds in their order. The patterns match what the kinds' rules say, written so that no character is tried twice.
BASE = ("email", "ip", "card", "phone")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: kind, pattern, what a text must hold for it.
GENERATORS = (
    ("email", EMAIL, "contains(t, '@')"),
    ("ip", IP, r"rlike(t, '[0-9]\\.[0-9]')"),
    ("card", CARD, "rlike(t, '[0-9]')"),
    ("phone", PHONE, "contains(t, '+')"),
    ("email_spelled", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,40}+\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{2,40}(?:\x20?[(\[]dot[)\]]\x20?[A-Za-z0-9-]{2,40}){1,4}", "rlike(t, '[(\\\\[]at[)\\\\]]')"),
    ("phone_local", r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9-])", "rlike(t, '[0-9]{3}[.-][0-9]{4}')"),
    ("national_id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "rlike(t, '-[0-9]{2}-')"),
    ("card_other", r"(?<![0-9])(?:[0-9]{13,15}|[0-9]{4}\x20[0-9]{6}\x20[0-9]{4,5}|[0-9]{4}-[0-9]{6}-[0-9]{4,5}|(?:[0-9]{4}\x20){3}[0-9]{4}|(?:[0-9]{4}-){3}[0-9]{4})(?![0-9])", "rlike(t, '[0-9]{6}|[0-9]{4}[ -][0-9]{4}')"),
)
KINDS = tuple(g[0] for g in GENERATORS)
AROUND = 24


def _ends(lengths: Column) -> Column:
    """Running sums, in blocks, so that a text with very many matches costs no square of their number."""
    block = 128

    def running(xs: Column, first: Column) -> Column:
        begin = F.array(first.cast("int"))
        return F.slice(F.aggregate(xs, begin, lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x))), 2, block + 1)

    blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(lengths) / block).cast("int") - 1), lambda i: F.slice(lengths, i * block + 1, block))
    sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x))
    before = F.aggregate(sums, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    return F.flatten(F.zip_with(blocks, F.slice(before, 1, F.size(blocks)), running))


def _found(kind: str, pattern: str, guard: str) -> Column:
    """array of (kind, a, b, match, before, after): leftmost non-overlapping matches in column t."""
    whole = rf"\G(?s:.*?)(?:{pattern})"
    head = rf"\G((?s:.*?))(?:{pattern})"
    none = F.array().cast("array<string>")
    guarded = lambda p, k: F.when(F.expr(guard), F.regexp_extract_all("t", F.lit(p), F.lit(k))).otherwise(none)
    heads, wholes = guarded(head, 1), guarded(whole, 0)
    parts = F.arrays_zip(F.transform(heads, F.length).alias("skip"), F.transform(wholes, F.length).alias("size"), wholes.alias("whole"))
    ends = F.when(F.size(wholes) > 0, _ends(F.transform(wholes, F.length))).otherwise(F.array().cast("array<int>"))

    def one(x: Column, end: Column) -> Column:
        start = end - x["size"] + x["skip"]
        return F.struct(
            F.lit(kind).alias("kind"),
            start.alias("a"),
            end.alias("b"),
            F.substring(x["whole"], x["skip"] + 1, x["size"] - x["skip"]).alias("match"),
            F.substring(x["whole"], F.greatest(x["skip"] - AROUND + 1, F.lit(1)), F.least(x["skip"], F.lit(AROUND))).alias("before"),
            F.substring(F.col("t"), end + 1, F.lit(1)).alias("after"),
        )

    return F.zip_with(parts, ends, one)


def luhn(digits: Column) -> Column:
    """Whether the last digit checks the others."""
    places = F.sequence(F.lit(1), F.length(digits))

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 0, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)
        return total + twice

    return F.when(F.length(digits) > 0, F.aggregate(places, F.lit(0), add) % 10 == 0).otherwise(False)


#: Four numbers of at most 255 each.
_BYTES = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"


def _digits() -> Column:
    return F.regexp_replace("match", "[^0-9]", "")


def accepted() -> Column:
    """The base kinds' rules."""
    n = F.length(_digits())
    return (
        F.when(F.col("kind") == "email", True)
        .when(F.col("kind") == "ip", F.col("match").rlike(_BYTES))
        .when(F.col("kind") == "card", F.when(n.between(16, 19), luhn(_digits())).otherwise(False))
        .when(F.col("kind") == "phone", n.between(8, 15))
        .otherwise(False)
    )


def features() -> dict[str, Column]:
    digits, match, before = _digits(), F.col("match"), F.lower("before")
    n = F.length(digits)
    has = lambda words: before.rlike(rf"(?:{words})").cast("double")
    out = {
        "size": F.length(match),
        "digits": n,
        "marks": F.length(F.regexp_replace(match, "[A-Za-z0-9]", "")),
        "at": F.length(F.regexp_replace(match, "[^@]", "")),
        "dots": F.length(F.regexp_replace(match, "[^.]", "")),
        "plus": match.startswith("+"),
        "luhn": F.when(n.between(13, 19), luhn(digits)).otherwise(False),
        "card_size": n.between(16, 19),
        "phone_size": n.between(8, 15),
        "issuer": digits.rlike("^(?:3[4678]|4|5[1-5]|6)"),
        "bytes": match.rlike(_BYTES),
        "area": digits.rlike("^[2-9]"),
        "numbered": ~match.rlike("^(?:000|666|9)|-00-|-0000$"),
        "name_ends": match.rlike("[A-Za-z]{2,}$"),
        "joined_before": before.rlike("[a-z0-9_]$"),
        "joined_after": F.col("after").rlike("[A-Za-z0-9_]"),
        "said_phone": has("phone|tel|call|fax|mobile|cell|reach|contact"),
        "said_card": has("card|visa|amex|account|pay"),
        "said_mail": has("mail|contact|write"),
        "said_id": has("ssn|social|tax|insur"),
        "said_code": has("version|order|serial|sku|isbn|part|ticket|lot |invoice|tracking|imei|model|build|ref"),
    }
    return {k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in out.items()} | {f"is_{k}": (F.col("kind") == k).cast("double") for k in KINDS}


#: What stands before planted values: fitting words by kind, and words for other numbers.
_FITTING = {
    "ip": ("from ", "host ", "address ", ""),
    "card": ("card ", "visa ", ""),
    "phone": ("call ", "phone: ", ""),
    "email_spelled": ("mail ", "write to ", "contact ", "e-mail: ", "ask ", ""),
    "phone_local": ("call ", "phone: ", "tel ", "my mobile is ", "fax ", "reach me at ", "cell ", ""),
    "national_id": ("ssn ", "social security number ", "SSN: ", "tax id ", "insured as ", ""),
    "card_other": ("card ", "amex ", "pay with ", "card number: ", "account ", ""),
}
#: Context words that no feature and no sentence of the fit holds, for right values and for other numbers.
UNSEEN = (
    {
        "email_spelled": ("ping ", "questions go to "), "phone_local": ("dial ", "ring ", "text me on ", "whatsapp "), "national_id": ("taxpayer no. ", "identity: ", "her nin is "),
        "card_other": ("mastercard ", "charge it to ", "billed on "), "ip": ("via ",), "phone": ("dial ", "ring "), "card": ("mastercard ",),
    },
    ("batch ", "docket ", "asset ", "barcode ", "article ", "seat ", "gate "),
)
_OTHER = ("order ", "serial ", "part no. ", "ticket ", "version ", "sku ", "isbn ", "lot ", "invoice ", "tracking ", "imei ", "model ", "build ", "ref ")
_OPENING = ("Hello, ", "as I said, ", "\n", "(", "Please note: ", "today. ", "we know that ", "une note : ")
_CLOSING = (".", ", thanks", "", " today", ")", "\n", " und so weiter", "; more")


def _draw(salt: str, n: int) -> Column:
    """A repeatable number from 0 to n - 1 for each planted row."""
    return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))


def _one_of(values, salt: str) -> Column:
    return F.element_at(F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values]), _draw(salt, len(values)).cast("int") + 1)


def _number(n: int, salt: str) -> Column:
    return F.lpad(_draw(salt, 10**n).cast("string"), n, "0")


def _grouped(digits: Column, sizes: tuple[int, ...], mark: str) -> Column:
    at, parts = 1, []
    for n in sizes:
        parts.append(F.substring(digits, at, n))
        at += n
    return F.concat_ws(mark, *parts)


def _card(right: Column) -> Column:
    """The digits of a card of 14, 15 or 16 (kind card: 16), with a right or a wrong check digit."""
    sixteen = F.concat(_one_of(("4", "5"), "issuer"), _number(14, "n"))
    body = F.when(F.col("want") == "card", sixteen).otherwise(_one_of((F.concat(_one_of(("34", "37"), "issuer"), _number(12, "n")), F.concat(_one_of(("36", "38"), "issuer"), _number(11, "n")), sixteen), "card"))
    digit = F.get(F.filter(F.sequence(F.lit(0), F.lit(9)), lambda d: luhn(F.concat(body, d.cast("string")))), F.lit(0))
    return F.concat(body, F.pmod(digit + F.when(right, 0).otherwise(_draw("off", 9) + 1), F.lit(10)).cast("string"))


def _value(kind: str, right: Column) -> Column:
    """A value of a kind, of right or of impossible form; a card's digits are in column card."""
    if kind == "ip":
        parts = [_draw(x, 256).cast("string") for x in "abcd"]
        large = (_draw("large", 744) + 256).cast("string")
        return F.when(right, F.concat_ws(".", *parts)).otherwise(_one_of([F.concat_ws(".", *parts[:k], large, *parts[k + 1 :]) for k in range(4)], "form"))
    if kind == "phone":
        return F.concat(F.lit("+"), _one_of(("1 ", "44 ", "(49) "), "land"), F.when(right, F.concat(_number(3, "a"), F.lit("-"), _number(6, "b"))).otherwise(_one_of((_number(3, "a"), F.concat(_number(9, "b"), F.lit("."), _number(7, "c"))), "form")))
    if kind == "card":
        short = _one_of((_grouped(F.col("card"), (3, 3, 4), "-"), F.substring("card", 1, 12), _grouped(F.col("card"), (2, 4), " ")), "short")
        whole = F.when(_draw("form", 2) == 0, F.col("card")).otherwise(_grouped(F.col("card"), (4, 4, 4, 4), " "))
        return F.when(~right & (_draw("cut", 2) == 0), short).otherwise(whole)
    if kind == "phone_local":
        area = F.concat(F.when(right, _draw("area", 8) + 2).otherwise(_draw("area", 2)).cast("string"), _number(2, "a"))
        b, c = _number(3, "b"), _number(4, "c")
        return _one_of((F.concat(F.lit("("), area, F.lit(") "), b, F.lit("-"), c), F.concat_ws("-", area, b, c), F.concat_ws(".", area, b, c)), "form")
    if kind == "national_id":
        area = F.lpad((_draw("area", 665) + 1).cast("string"), 3, "0")
        good = F.concat_ws("-", area, F.lpad((_draw("b", 99) + 1).cast("string"), 2, "0"), F.lpad((_draw("c", 9999) + 1).cast("string"), 4, "0"))
        bad = _one_of((F.concat_ws("-", F.lit("000"), _number(2, "b"), _number(4, "c")), F.concat_ws("-", F.lit("666"), _number(2, "b"), _number(4, "c")), F.concat_ws("-", F.concat(F.lit("9"), _number(2, "a")), _number(2, "b"), _number(4, "c")), F.concat_ws("-", area, F.lit("00"), _number(4, "c")), F.concat_ws("-", area, _number(2, "b"), F.lit("0000"))), "form")
        return F.when(right, good).otherwise(bad)
    if kind == "card_other":
        n, card = F.length("card"), F.col("card")
        parted = F.when(n == 16, _grouped(card, (4, 4, 4, 4), " ")).otherwise(_grouped(card, (4, 6, 5), " "))
        return F.when((n < 16) & (_draw("form", 3) == 0), card).when(_draw("form", 3) == 1, F.translate(parted, " ", "-")).otherwise(parted)
    name = F.concat(_one_of(("bob", "anna.k", "info", "j_doe", "sales"), "who"), _one_of(("", "7", "x"), "more"))
    host, end = _one_of(("example", "mail", "uni-x", "firma"), "host"), F.when(right, _one_of(("com", "org", "de", "net"), "end")).otherwise(_draw("end", 90).cast("string"))
    at, dot = _one_of((" [at] ", "(at)", " (at) ", "[at]"), "at"), _one_of((" [dot] ", "(dot)", " (dot) ", "[dot]"), "dot")
    return F.concat(name, at, host, dot, end)


def planted(spark: SparkSession, n: int = PLANTED, fitting: dict | None = None, others: tuple = _OTHER) -> DataFrame:
    """(kind, match, before, after, label, cue): candidates of planted sentences, as the generators find them. ``fitting`` and ``others``: the context words."""
    fitting = fitting or _FITTING
    kinds = list(fitting)
    rows = spark.range(n).withColumn("want", _one_of(kinds, "kind")).withColumns({"right": _draw("right", 4) < 3, "fits": _draw("fits", 3) < 2})
    by_kind = lambda of: reduce(lambda c, k: c.when(F.col("want") == k, of(k)), kinds[1:], F.when(F.col("want") == kinds[0], of(kinds[0])))
    # an address is one after any words, and base kinds are what their form says; in front of other numbers the words decide
    fits = F.col("fits") | F.col("want").isin("email_spelled", *BASE)
    cue = F.when(fits, by_kind(lambda k: _one_of(fitting[k], "cue"))).otherwise(_one_of(others, "cue"))
    rows = cut(rows.withColumn("card", _card(F.col("right"))).coalesce(1))  # n short rows
    rows = rows.select("want", cue.alias("cue"), (F.col("right") & fits).cast("double").alias("label"), by_kind(lambda k: _value(k, F.col("right"))).alias("value"), _one_of(_OPENING, "opening").alias("opening"), _one_of(_CLOSING, "closing").alias("tail"))
    rows = cut(rows.coalesce(1)).withColumn("t", F.concat("opening", "cue", "value", "tail"))  # n short rows
    found = F.concat(*[_found(*g) for g in GENERATORS if g[0] in fitting])
    return rows.select("want", "label", "value", "cue", F.inline(found)).filter("kind = want and match = value").select("kind", "match", "before", "after", "label", "cue")


def _tree(node, names: list[str]) -> str:
    """A regression tree as SQL."""
    if node.numDescendants() == 0:
        return repr(float(node.prediction()))
    split = node.split()
    return f"CASE WHEN {names[split.featureIndex()]} <= {split.threshold()!r} THEN {_tree(node.leftChild(), names)} ELSE {_tree(node.rightChild(), names)} END"


@dataclass(frozen=True)
class Model:
    """``score``: SQL over the columns f_*; ``cuts``: the threshold of each kind; ``held`` and ``unseen``: precision and recall of each kind there."""

    score: str
    cuts: dict[str, float]
    held: dict[str, dict[str, float]]
    unseen: dict[str, dict[str, float]]


def _with_features(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select("kind", "label", *keep, *[v.alias(f"f_{k}") for k, v in features().items()])


def _told(rows: DataFrame, score: str) -> dict[str, list]:
    """By kind: (score, good, n) from the highest score down; a few scores of a bounded sample."""
    found = rows.select("kind", "label", F.round(F.expr(score), 4).alias("s")).groupBy("kind", "s").agg(F.sum("label").alias("good"), F.count(F.lit(1)).alias("n")).collect()
    return {k: sorted(((r.s, r.good, r.n) for r in found if r.kind == k), reverse=True) for k in KINDS}


def fit(spark: SparkSession, corpus: DataFrame | None = None) -> Model:
    """``corpus``: candidates (kind, match, before, after) of documents, whose base matches are added to the sample."""
    sample = planted(spark)
    if corpus is not None:
        seen = corpus.filter(F.col("kind").isin(*BASE)).groupBy("kind", "match").agg(F.min(F.struct("before", "after")).alias("x"))
        seen = seen.select("kind", "match", "x.before", "x.after").withColumn("label", accepted().cast("double"))
        seen = cut(seen.select("*", F.xxhash64("match").alias("h")))
        parts = [seen.filter((F.col("kind") == k) & (F.col("label") == v)).orderBy("h", "match").limit(QUOTA).drop("h") for k in BASE for v in (0.0, 1.0)]
        sample = reduce(DataFrame.unionByName, [p.withColumn("cue", F.lit("")) for p in parts], sample)
    words = [c for many in (*_FITTING.values(), _OTHER) for c in many[2::3]]
    rows = cut(_with_features(sample.withColumn("held", F.col("cue").isin(*words)), "held").coalesce(1))  # 8 QUOTA + PLANTED rows at most
    names = [f"f_{k}" for k in features()]
    train = VectorAssembler(inputCols=names, outputCol="features").transform(rows.filter("not held")).select("features", "label")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=16, stepSize=0.3, seed=1, cacheNodeIds=False).fit(train)
    trees = [_tree(t._java_obj.rootNode(), names) for t in model.trees]
    score = "1 / (1 + exp(-2 * (" + " + ".join(f"{w!r} * ({t})" for w, t in zip(map(float, model.treeWeights), trees, strict=True)) + ")))"
    cuts: dict[str, float] = {}
    for kind, told in _told(rows.filter("held"), score).items():
        good = n = 0
        for s, g, k in told:
            good, n = good + g, n + k
            if good >= PRECISION * n:
                cuts[kind] = s

    def report(part: DataFrame) -> dict[str, dict[str, float]]:
        out = {}
        for kind, told in _told(part, score).items():
            passed = [(g, n) for s, g, n in told if s >= cuts.get(kind, 2.0)]
            good, n, total = sum(g for g, _ in passed), sum(n for _, n in passed), sum(g for _, g, _ in told)
            if total:
                out[kind] = {"precision": round(good / n, 4) if n else 1.0, "recall": round(good / total, 4), "rows": sum(n for _, _, n in told)}
        return out

    return Model(score, cuts, report(rows.filter("held")), report(cut(_with_features(planted(spark, PLANTED // 2, *UNSEEN)))))


def write_model(spark: SparkSession, path: str = MODEL) -> Model:
    """Fit and keep; done by hand when the generators, features or sentences change."""
    model = fit(spark)
    with open(path, "w") as out:
        json.dump(asdict(model), out, indent=1, sort_keys=True)
    return model


def stored(path: str = MODEL) -> Model:
    with open(path) as kept:
        return Model(**json.load(kept))


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, rid, found: one row for each row of ``docs``."""
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("rid"), text_or_empty().alias("t"))
    kind = "array<struct<kind:string,a:int,b:int,match:string,before:string,after:string>>"
    found = F.concat(*[_found(*g).cast(kind) for g in GENERATORS])
    any_sign = F.expr("rlike(t, '[0-9@]') or rlike(t, '[(\\\\[]at[)\\\\]]')")  # all generators need one of these
    return rows.select("doc_id", "rid", F.when(any_sign, found).otherwise(F.array().cast(kind)).alias("found"))


def pii_spans(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans. ``model``: another than the stored one."""
    model = model or stored()
    rows = cut(candidates(docs))
    single = rows.filter("size(found) > 0").select("doc_id", "rid", F.inline("found"))
    score, cuts = F.expr(model.score), model.cuts
    least = reduce(lambda c, k: c.when(F.col("kind") == k, F.lit(cuts.get(k, 2.0))), KINDS[1:], F.when(F.col("kind") == KINDS[0], F.lit(cuts.get(KINDS[0], 2.0))))
    others = single.filter(~F.coalesce(accepted(), F.lit(False)))
    scored = others.select("*", *[v.alias(f"f_{k}") for k, v in features().items()]).withColumn("score", score)
    # a generator, not a filter: a filter would be pushed below the features and hold each of them as often as the trees name it
    scored = scored.select("doc_id", "rid", "kind", "a", "b", "score", F.explode(F.when(F.round("score", 4) >= least, F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))))
    spans = single.filter(accepted()).select("doc_id", "rid", "kind", "a", "b", F.lit(True).alias("base"), F.lit(1.0).alias("score"))
    spans = spans.unionByName(scored.select("doc_id", "rid", "kind", "a", "b", F.lit(False).alias("base"), "score"))
    order = reduce(lambda c, k: c.when(F.col("kind") == k[1], k[0]), list(enumerate(KINDS))[1:], F.when(F.col("kind") == KINDS[0], 0))
    spans = spans.groupBy("doc_id", "rid").agg(F.array_sort(F.collect_list(F.struct(order.alias("k"), "a", "b", "kind", "base", "score"))).alias("s"))
    taken = F.filter("s", lambda x: x["base"])
    more = F.filter("s", lambda x: ~x["base"] & ~F.exists(taken, lambda y: (x["a"] < y["b"]) & (y["a"] < x["b"])))
    by_place = F.array_sort(F.transform(more, lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"), x["k"].alias("k"), x["kind"].alias("kind"), x["score"].alias("score"))))
    begin = F.array().cast("array<struct<a:int,b:int,k:int,kind:string,score:double>>")

    def add(done: Column, x: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        better = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(x))
        return F.when(F.coalesce(last["b"] > x["a"], F.lit(False)), F.when(x["score"] > last["score"], better).otherwise(done)).otherwise(F.concat(done, F.array(x)))

    more = F.array_sort(F.transform(F.aggregate(by_place, begin, add), lambda x: F.struct(x["k"].alias("k"), x["a"].alias("a"), x["b"].alias("b"), x["kind"].alias("kind"))))
    said = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["a"], x["b"])), ",")
    count = lambda k: F.size(F.filter("taken", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    spans = spans.select("rid", F.transform(taken, lambda x: F.struct(x["k"].alias("k"), x["a"].alias("a"), x["b"].alias("b"), x["kind"].alias("kind"))).alias("taken"), more.alias("more"))
    with_spans = spans.select("rid", *map(count, BASE), F.sha2(said(F.col("taken")), 256).alias("base_sha256"), said(F.concat("taken", "more")).alias("spans"), (F.size("taken") + F.size("more")).cast("long").alias("n_spans"))
    values = rows.select("rid", "doc_id").join(with_spans, "rid", "left")
    none = F.lit(0).cast("long")
    return values.select(
        "doc_id", *[F.coalesce(f"n_{k}", none).alias(f"n_{k}") for k in BASE], F.coalesce("base_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"), F.coalesce("n_spans", none).alias("n_spans")
    )


def covered_by(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with ``mark`` in place of each run of overlapping spans; ``spans``: the column that pii_spans gives."""
    part = lambda x, i: F.element_at(F.split(x, ":"), i).cast("int")
    places = F.array_sort(F.transform(F.split(spans, ","), lambda x: F.struct(part(x, 2).alias("a"), part(x, 3).alias("b"))))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def add(done: Column, x: Column) -> Column:
        kept = F.concat(done["out"], F.array(F.substring(text, done["at"] + 1, x["a"] - done["at"]), F.lit(mark)))
        out = F.when(x["a"] >= done["at"], kept).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], x["b"]).alias("at"), out.alias("out"))

    return F.aggregate(places, begin, add, lambda done: F.concat(F.array_join(done["out"], ""), F.substring(text, done["at"] + 1, F.length(text))))


def redacted(docs: DataFrame, mark: str = "<PII>", model: Model | None = None) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark``; same rows and columns, a null text stays null."""
    text = text_or_empty()
    # equal texts have equal spans, so the spans travel by a digest of the text
    found = pii_spans(docs.select(F.sha2(text, 256).alias("doc_id"), F.col("text")), model).filter("spans <> ''")
    sha, spans = spare(docs, "sha", "spans")
    found = cut(found.groupBy(F.col("doc_id").alias(sha)).agg(F.first("spans").alias(spans)))
    rows = docs.withColumn(sha, F.sha2(text, 256)).join(measured(found), sha, "left")
    clean = F.when(F.col(spans).isNull(), F.col("text")).otherwise(covered_by(F.col("text"), F.col(spans), mark)).alias("text")
    return rows.select(*[clean if c == "text" else x for c, x in zip(docs.columns, own_columns(docs), strict=True)])
