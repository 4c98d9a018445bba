"""Personal data by candidate gradient boosting, in DataFrame functions only.

Exact patterns with their checks give the base spans. Wider generators propose further candidates: numbers in groups,
written-out addresses, dotted numbers. Boosted trees score each candidate by its format and its surroundings. Examples are
format variants of base spans where they stand (sign dropped, separators swapped, @ and . written out); counter-examples are
candidates, and spoilt variants, that fail the check of their kind or stand in surroundings that are not personal (inside
an identifier, behind 'version', 'ISBN' and the like). All other candidates are not learned from. Per kind, the lowest score
that keeps the wanted precision on held-back base spans and candidates is the threshold. Candidates above it are
added if they touch no base span or extend one of their kind; base spans always stay.

The trees become column expressions, so scoring is part of the scan: no shuffle, no Python on the executors.

Edge cases: null and empty texts have no spans; to a kind without base spans nothing is added, as it has no examples;
repeated rows each get their result; an empty table gives no rows; input columns are kept, added columns replace ones of the same names.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from berthlake.functions.barrier import compute_once
from berthlake.llm.columns import sets_aside

KINDS = ["email", "ip", "card", "phone"]

# Leftmost matches of the base patterns. A run of local characters or digits is entered at its start (or where the last match
# ended) and not given back, so that a long run is read once.
LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HOST = "[A-Za-z0-9-]++"
WIDE = {
    "email": [rf"(?:(?<!{LOCAL})|\G){LOCAL}++(?:\x20?(?:@|[\(\[](?i:at)[\)\]])\x20?{HOST}(?:(?:\.|\x20?[\(\[](?i:dot)[\)\]]\x20?){HOST})*+"
              rf"|\x20(?i:at)\x20{HOST}(?:\x20(?i:dot)\x20{HOST})++)"],
    "ip": [r"[0-9]++(?:(?:[.,]|\[\.\])[0-9]++)++"],
    # the second is for cards that stand side by side
    "card": [r"[0-9]++(?:[\x20./-]?[0-9]++)++", "(?<![0-9])[0-9]{16,19}(?![0-9])"],
    "phone": [r"[(]?[0-9]++(?:(?:\x20?[(]|[)][\x20./-]?|\x20[/-]\x20|[\x20./-])[0-9]++)*+"],
}
ONE_OF = {"email": r"@|[\(\[](?i:at)[\)\]]|\x20(?i:at)\x20[A-Za-z0-9-]++\x20(?i:dot)\x20", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
BEFORE, AFTER = 24, 4
HINTS = {"email": "(?i)mail", "ip": r"(?i)\bip|host|addr", "card": "(?i)card|visa|kart|carte", "phone": "(?i)tel|phone|fon|call"}

# what stands before a number that is no personal data
FOREIGN = (r"(?i)\b(?:version|release|build|isbn|issn|doi|order|invoice|ticket|serial|part|item|section|chapter|hash|token|price|total|id|no|nr|v)"
           r"[\s.:#='\x22-]*$|[$€£#§]\x20?$")
FOREIGN_BEFORE = {"email": "token: ", "ip": "version ", "card": "ISBN ", "phone": "order no. "}
DATES = r"^(?:(?:19|20)[0-9]{2}[\x20./-]+(?:[0-9]{1,2}[\x20./-]|(?:19|20)[0-9]{2}$)|[0-9]{1,2}[\x20./-][0-9]{1,2}[\x20./-](?:19|20)[0-9]{2}(?![0-9]))"

TREES, DEPTH, BINS = 10, 3, 256
PRECISION = 0.98
MARGIN_STEPS = 1000  # per unit; thresholds lie on these steps
NUMBER_CHUNK = 512

SPAN = "array<struct<kind:string,start:bigint,end:bigint,body:string,before:string,after:string>>"
FEATURES = ["kind", "chars", "digits", "letters", "gaps", "groups", "longest", "luhn", "octets", "checked", "glued_left", "glued_right",
            "foreign", "hint"]


class Model(NamedTuple):
    trees: list[tuple[float, object]]   # weight and nested (feature, threshold, left, right) or leaf value
    thresholds: dict[str, float]


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once: as the variable of a lambda it is not repeated for each element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running_sum(lengths: Column) -> Column:
    """Sums of the entries before each one. Chunks keep the cost near linear, as growing an array copies it."""
    zero = F.lit(0).cast("bigint")

    def grow(start: Column, items: Column) -> Column:
        return F.aggregate(items, F.array(start), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    def summed(chunks: Column) -> Column:
        firsts = grow(zero, F.transform(chunks, lambda c: F.aggregate(c, zero, lambda s, x: s + x)))
        return F.flatten(F.zip_with(chunks, F.slice(firsts, 1, F.size(chunks)), lambda c, first: F.slice(grow(first, c), 1, F.size(c))))

    numbers = F.sequence(F.lit(0), F.greatest(F.floor((F.size(lengths) - 1) / NUMBER_CHUNK), F.lit(0)).cast("int"))
    return let(F.transform(numbers, lambda b: F.slice(lengths, b * NUMBER_CHUNK + 1, NUMBER_CHUNK)), summed)


def matches(text: Column, kind: str, pattern: str) -> Column:
    """All leftmost matches with places in code points and some text around; gaps and matches take turns in a text."""
    def placed(v: Column) -> Column:
        return F.transform(F.arrays_zip(v["found"], v["gaps"], v["next"], v["sums"]), lambda r: F.struct(
            F.lit(kind).alias("kind"), (r["sums"] + F.length(r["gaps"])).alias("start"),
            (r["sums"] + F.length(r["gaps"]) + F.length(r["found"])).alias("end"), r["found"].alias("body"),
            F.right(r["gaps"], F.lit(BEFORE)).alias("before"), F.left(r["next"], F.lit(AFTER)).alias("after")))

    def summed(v: Column) -> Column:
        sums = let(F.zip_with(v["found"], v["gaps"], lambda m, g: (F.length(m) + F.length(g)).cast("bigint")), running_sum)
        return let(F.struct(v["found"].alias("found"), v["gaps"].alias("gaps"), v["next"].alias("next"), sums.alias("sums")), placed)

    def paired(v: Column) -> Column:
        n = F.size(v["found"])
        return let(F.struct(v["found"].alias("found"), F.slice(v["gaps"], 1, n).alias("gaps"), F.slice(v["gaps"], 2, n).alias("next")), summed)

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    spans = let(F.struct(found.alias("found"), F.split(text, pattern, -1).alias("gaps")), paired)
    has = F.regexp_like(text, F.lit(ONE_OF[kind]))
    return F.when(has, spans).otherwise(F.array().cast(SPAN))


def digits(body: Column) -> Column:
    return F.regexp_replace(body, "[^0-9]", "")


def octets(body: Column) -> Column:
    parts = F.transform(F.split(body, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    return F.forall(parts, lambda p: F.when(F.length(p) <= 3, F.coalesce(p.try_cast("int"), F.lit(256)) <= 255).otherwise(False))


def passes(kind: str, body: Column) -> Column:
    if kind == "ip":
        return octets(body)
    if kind == "card":
        return F.length(digits(body)).between(16, 19) & F.call_function("luhn_check", digits(body))
    if kind == "phone":
        return F.length(digits(body)).between(8, 15)
    return F.lit(True)


def candidates(docs: DataFrame, text: str, generated: bool = True) -> DataFrame:
    """Add ``_base`` (valid base spans, by kind and start) and, if ``generated``, ``_wide`` (candidates of the generators)."""
    body = F.coalesce(F.col(text), F.lit(""))

    def valid(kind: str) -> Column:
        return F.filter(matches(body, kind, BASE[kind]), lambda s: passes(kind, s["body"]))

    base = [valid(k) for k in KINDS]
    wide = [matches(body, k, p) for k in KINDS for p in WIDE[k]]
    # each list is computed once per row: behind this it is only a column
    return compute_once(docs, _base=F.concat(*base), **({"_wide": F.concat(*wide)} if generated else {}))


def by_kind(kind: Column, values: dict[str, Column]) -> Column:
    return reduce(lambda rest, k: F.when(kind == k, values[k]).otherwise(rest), values, F.lit(None))


def number_groups(body: Column) -> Column:
    return F.regexp_extract_all(body, F.lit("[0-9]+"), F.lit(0))


def four_octets(body: Column) -> Column:
    groups = number_groups(body)
    return (F.size(groups) == 4) & F.forall(groups, lambda g: F.when(F.length(g) <= 3, g.try_cast("int") <= 255).otherwise(False))


def hinted(s: Column) -> Column:
    return by_kind(s["kind"], {k: F.regexp_like(s["before"], F.lit(HINTS[k])) for k in KINDS})


def checked(s: Column) -> Column:
    """The check of the kind, whatever the separators are."""
    body, number = s["body"], digits(s["body"])
    groups = F.size(number_groups(body))
    phone = F.length(number).between(8, 15) & ~F.regexp_like(body, F.lit(DATES)) & (groups <= 6) & (F.length(number) >= 2 * groups)
    return by_kind(s["kind"], {
        "email": F.regexp_like(body, F.lit(r"(?i)(?:@|at[\)\]\x20]).*(?:\.|dot[\)\]]?)\x20?[A-Za-z][A-Za-z0-9-]+$")),
        # thousands are grouped by commas too
        "ip": four_octets(body) & (hinted(s) | ~F.regexp_like(body, F.lit("^[0-9]+(?:,[0-9]{3})+$"))),
        "card": F.length(number).between(16, 19) & F.call_function("luhn_check", number),
        # a bare or decimal number is one only if something says so
        "phone": phone & (hinted(s) | ~F.regexp_like(body, F.lit(r"^[0-9]+(?:\.[0-9]+)?$"))),
    })


def glued(s: Column) -> tuple[Column, Column]:
    return F.regexp_like(s["before"], F.lit(r"[\p{L}0-9]$")), F.regexp_like(s["after"], F.lit(r"^[\p{L}0-9]"))


def feature_columns(s: Column) -> dict[str, Column]:
    body = s["body"]
    number = digits(body)
    left, right = glued(s)
    made = {
        "kind": F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]),
        "chars": F.length(body), "digits": F.length(number),
        "letters": F.length(F.regexp_replace(body, "[^A-Za-z]", "")),
        "gaps": F.length(F.regexp_replace(body, "[A-Za-z0-9]", "")),
        "groups": F.size(number_groups(body)),
        "longest": F.array_max(F.transform(number_groups(body), F.length)),
        "luhn": F.length(number).between(16, 19) & F.call_function("luhn_check", number),
        "octets": four_octets(body),
        "checked": checked(s),
        "glued_left": left,
        "glued_right": right,
        "foreign": F.regexp_like(s["before"], F.lit(FOREIGN)),
        "hint": hinted(s),
    }
    return {k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in made.items()}


def overlaps(b: Column, s: Column) -> Column:
    return (b["start"] < s["end"]) & (s["start"] < b["end"])


def extends(b: Column, s: Column) -> Column:
    """The candidate has the base span of its kind, whose sign may be missing, and more."""
    return (b["kind"] == s["kind"]) & (s["start"] <= b["start"] + 1) & (s["end"] >= b["end"]) & ((s["start"] < b["start"]) | (s["end"] > b["end"]))


def open_to(spans: Column, s: Column) -> Column:
    """No base span stands against adding the candidate."""
    return F.forall(spans, lambda b: ~overlaps(b, s) | extends(b, s))


def personal_place(s: Column) -> Column:
    left, right = glued(s)
    return ~(left | right | (F.regexp_like(s["before"], F.lit(FOREIGN)) & ~hinted(s)))


def variants(s: Column) -> Column:
    """Other ways to write a base span, then spoilt ones, then ones in foreign surroundings; by (body, before, after)."""
    body, number = s["body"], digits(s["body"])
    local, host = F.substring_index(body, "@", 1), F.substring_index(body, "@", -1)
    bare = F.substr(body, F.lit(2))

    def cards(d: Column, gap: str) -> Column:
        return F.concat_ws(gap, *(F.substr(d, F.lit(k), F.lit(4)) for k in (1, 5, 9)), F.substr(d, F.lit(13)))

    next_digit = F.pmod(F.right(number, F.lit(1)).try_cast("int") + 1, F.lit(10)).cast("string")
    spoilt = F.concat(F.left(number, F.length(number) - 1), next_digit)
    commas = F.replace(body, F.lit("."), F.lit(","))
    written = {
        "email": [F.concat(local, F.lit(a), F.replace(host, F.lit("."), F.lit(d))) for a, d in
                  ((" [at] ", " [dot] "), ("(at)", "(dot)"), ("[at]", "."), (" @ ", "."), (" at ", " dot "))],
        "ip": [commas, F.regexp_replace(body, r"^([0-9]+)\.", "$1,"), F.replace(body, F.lit("."), F.lit("[.]"))],
        "card": [cards(number, "/"), cards(number, "."), F.regexp_replace(cards(number, "/"), "/([0-9]+)$", " $1"), number],
        "phone": [bare, F.regexp_replace(body, r"^\+[0-9]+[\x20.-]?", ""), *(F.regexp_replace(bare, "[^0-9]+", gap) for gap in "-./ ")],
    }
    wrong = {
        "email": [F.concat(local, F.lit(a), F.replace(host, F.lit("."), F.lit("-"))) for a in (" [at] ", " @ ", "@")],
        "ip": [F.regexp_replace(commas, ",[0-9]+$", ""), F.regexp_replace(commas, "^[0-9]+", "777"), F.concat(commas, F.lit(",1"))],
        "card": [cards(spoilt, "/"), cards(spoilt, "."), F.left(cards(number, "/"), F.lit(14)), spoilt],
        "phone": [F.left(bare, F.lit(7)), F.lit("2019-05-17"), F.lit("1998-2004"), F.concat(F.left(number, F.lit(5)), F.lit("."), F.right(number, F.lit(4))), number],
    }

    def placed(bodies: Column, before: Column, after: Column) -> Column:
        return F.transform(bodies, lambda v: F.struct(s["kind"].alias("kind"), v.alias("body"), before.alias("before"), after.alias("after")))

    def one(values: dict[str, list[Column]]) -> Column:
        return by_kind(s["kind"], {k: F.array(*v) for k, v in values.items()})

    good = one(written)
    # the gap before a match may end in the sign of a phone number; a variant has none
    return F.concat(
        placed(F.concat(good, one(wrong)), s["before"], s["after"]),
        placed(F.slice(good, 1, 2), F.concat(s["before"], by_kind(s["kind"], {k: F.lit(v) for k, v in FOREIGN_BEFORE.items()})), s["after"]),
        placed(F.slice(good, 1, 2), F.concat(s["before"], F.lit("e3")), s["after"]),
        placed(F.slice(good, 1, 2), s["before"], F.concat(F.lit("f0"), s["after"])))


def examples(docs: DataFrame, text: str = "text") -> DataFrame:
    """Feature vectors of all examples with their label, their side of the split (``held``) and their number ``n``.

    Every distinct base span and counter-example of the table counts. Features are small whole numbers, so equal vectors are
    many; they are counted below the exchange.
    """
    texts = docs.select(F.col(text).alias("text"))
    place = ["kind", "body", "before", "after"]

    def distinct(found: DataFrame, spans: Column) -> DataFrame:
        # what a base span and its copies teach stays on one side of the split
        own = found.select(F.explode(spans).alias("c")).select(*(F.col(f"c.{k}").alias(k) for k in place)).dropDuplicates(place)
        return own.withColumn("_order", F.xxhash64("kind", "body"))

    c = F.struct(*place)
    spans = distinct(candidates(texts, "text", False), F.col("_base")).select("_order", F.explode(variants(c)).alias("v")).select("v.*", "_order")
    spans = spans.withColumn("label", F.when(checked(c) & personal_place(c), 1.0).otherwise(0.0))
    # the checks are left to the distinct ones, as most candidates fail them
    against = distinct(candidates(texts, "text"), F.filter("_wide", lambda s: open_to(F.col("_base"), s)))
    against = against.filter(~(F.coalesce(checked(c), F.lit(False)) & personal_place(c))).withColumn("label", F.lit(0.0))
    rows = spans.unionByName(against)
    made = rows.select(F.col("kind").alias("name"), "label", (F.col("_order") % 4 == 0).alias("held"), *(v.alias(k) for k, v in feature_columns(c).items()))
    return made.groupBy(*made.columns).agg(F.count(F.lit(1)).cast("double").alias("n"))


def fit(docs: DataFrame, text: str = "text") -> Model | None:
    """Trees and thresholds from all base spans and counter-examples of the table."""
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(examples(docs, text)).cache()
    kinds = {r[0] for r in rows.filter("NOT held").select("label").distinct().collect()}
    if len(kinds) < 2:
        rows.unpersist()
        return None
    booster = GBTClassifier(
        maxIter=TREES, maxDepth=DEPTH, maxBins=BINS, seed=7, stepSize=0.3, labelCol="label", featuresCol="features", weightCol="n")
    model: GBTClassificationModel = booster.fit(rows.filter("NOT held"))
    trees = [(float(w), nested(t._java_obj.rootNode())) for w, t in zip(model.treeWeights, model.trees)]
    # one row per kind and step of the margin, so their number does not grow with the table
    margins = rows.filter("held").select("name", "label", "n", margin(trees, {k: F.col(k) for k in FEATURES}).alias("m"))
    held = margins.groupBy("name", F.floor(F.col("m") * MARGIN_STEPS).alias("step")).agg(
        F.min("m").alias("m"), F.sum(F.col("n") * F.col("label")).alias("good"), F.sum("n").alias("n")).collect()
    rows.unpersist()
    thresholds = {}
    for kind in KINDS:
        good, seen, best = 0.0, 0.0, None
        for r in sorted((r for r in held if r["name"] == kind), key=lambda r: -r["m"]):
            good, seen = good + r["good"], seen + r["n"]
            if good >= PRECISION * seen:
                best = r["m"]
        if best is not None and best > 0:
            thresholds[kind] = best
    return Model(trees, thresholds)


def nested(node) -> object:
    """A fitted tree as nested tuples."""
    if node.numDescendants() == 0:
        return float(node.prediction())
    split = node.split()
    return (FEATURES[split.featureIndex()], float(split.threshold()), nested(node.leftChild()), nested(node.rightChild()))


def margin(trees: list, values: dict[str, Column]) -> Column:
    def walk(node) -> Column:
        if isinstance(node, float):
            return F.lit(node)
        name, threshold, left, right = node
        return F.when(values[name] <= threshold, walk(left)).otherwise(walk(right))

    return reduce(lambda a, b: a + b, (walk(t) * F.lit(w) for w, t in trees), F.lit(0.0))


@sets_aside("_base", "_wide", "_once", "_text")
def find(docs: DataFrame, model: Model | None = None, text: str = "text") -> DataFrame:
    """Add ``pii_base`` and ``pii_spans``: arrays of (kind, start, end), by kind as in KINDS and start."""
    model = model or fit(docs, text)
    found = candidates(docs, text)
    added = F.array().cast(SPAN)
    if model and model.thresholds:
        def chosen(s: Column) -> Column:
            threshold = reduce(lambda rest, k: F.when(s["kind"] == k, F.lit(model.thresholds[k])).otherwise(rest),
                               model.thresholds, F.lit(float("inf")))
            values = F.struct(*(v.alias(k) for k, v in feature_columns(s).items()))
            return open_to(F.col("_base"), s) & let(values, lambda v: margin(model.trees, {k: v[k] for k in FEATURES}) >= threshold)

        added = F.filter("_wide", chosen)
    plain = "array<struct<kind:string,start:bigint,end:bigint>>"

    def cut(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).cast(plain)

    order = F.array(*map(F.lit, KINDS))
    ranked = F.array_sort(F.transform(F.concat(F.col("_base"), added), lambda s: F.struct(
        F.array_position(order, s["kind"]).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return found.withColumns({"pii_base": cut(F.col("_base")), "pii_spans": cut(ranked)}).drop("_base", "_wide")


@sets_aside("_s", "pii_base", "pii_spans")
def redact(docs: DataFrame, model: Model | None = None, text: str = "text") -> DataFrame:
    """The documents with each span, or run of overlapping spans, replaced by its kind in brackets."""
    found = find(docs, model, text)
    sorted_ = F.array_sort(F.transform("pii_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    zero = F.lit(0).cast("bigint")
    state = F.aggregate(
        sorted_, F.struct(zero.alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda acc, s: F.when(s["start"] < acc["at"], F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["parts"].alias("parts"))).otherwise(
            F.struct(s["end"].alias("at"), F.concat(acc["parts"], F.array(
                F.substr(F.col(text), acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))).alias("parts"))))
    done = found.withColumn("_s", state)
    clean = F.concat(F.array_join("_s.parts", ""), F.substr(F.col(text), F.col("_s.at") + 1))
    return done.withColumn(text, F.when(F.size("pii_spans") > 0, clean).otherwise(F.col(text))).select(*docs.columns)


def of_kind(spans: Column | str, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
