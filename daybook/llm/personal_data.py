"""Personal data: certain patterns, and candidates chosen by boosted trees. DataFrame and SQL functions only.

**Base spans** (e-mail, IP, card and phone, each checked) always count. **Candidates** come from three generous generators (``GENERATORS``)
whose spans may overlap: loose e-mail forms, groups of digits, and letters with digits as in account numbers. Every candidate has
features of its form and of the text around it. Gradient-boosted trees learn which candidates look like
base spans, from all documents but a third; a threshold for every generator is calibrated on that third, so that at
least ``PRECISION`` of what passes is right there. Candidates that pass and overlap no base span are added.

The trees are written out as one SQL expression over the candidates of a row, so scoring is part of the scan: there is no
explode, shuffle or UDF. Only the candidates' histogram and the trees pass the driver.

Matches are found in one pass per kind: the pattern marks its matches, a split at the marks gives the pieces, and running
lengths give the positions. The patterns have no nested repetition, so long texts cannot overflow the stack: separators inside a
number or dots inside a domain are first replaced by a mark of the same length.

Null texts count as empty. Rows repeated in the input are reported each; without candidates of both kinds nothing is added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import store

PRECISION = 0.99
KINDS = ["email", "ip", "card", "phone"]
JOINER, MARK, SPARE = "\u0001", "\u0002", "\u0003"

EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+\x01-]))[A-Za-z0-9._%+\x01-]++@[A-Za-z0-9-]++\x01[A-Za-z0-9\x01-]++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9][0-9\x01]{13,}+"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"

GENERATORS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]{1,64}+ ?(?:@|\[at\]|\(at\)) ?[A-Za-z0-9-]{1,63}+ ?(?:\.|\[dot\]|\(dot\)) ?[A-Za-z]{2,24}",
    "number": r"[+(]?[0-9](?:[ ().:/+-]{0,3}+[0-9]){2,40}+",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9 ]{10,30}(?![A-Za-z0-9])",
}
SHORTEST_NUMBER = 6
CONTEXT = 24
FEATURES = 14
CELL = 256


def pieces(text: Column, pattern: str) -> Column:
    """The text before, in and after each match of the pattern, in turn."""
    return F.split(F.regexp_replace(text, pattern, MARK + "$0" + MARK), MARK, -1)


def running(numbers: Column, combine) -> Column:
    """Running sums or maxima of an array of numbers, none below 0.

    By doubling: in each round every entry takes up the one so many places before it. So n entries take n log n steps, and no array is
    built entry by entry.
    """
    rounds = F.sequence(F.lit(0), F.greatest(F.ceil(F.log2(F.size(numbers).cast("double"))).cast("int"), F.lit(0)))
    return F.aggregate(
        rounds, numbers,
        lambda done, k: F.zip_with(done, F.slice(F.concat(F.array_repeat(F.lit(0), F.pow(F.lit(2), k).cast("int")), done), 1, F.size(done)), combine),
    )


def matches(parts: Column) -> Column:
    """(start, end, text) of the matches among pieces, in code points."""
    ends = running(F.transform(parts, F.length), lambda a, b: a + b)
    placed = F.zip_with(parts, ends, lambda part, end: F.struct((end - F.length(part)).alias("start"), end.alias("end"), part.alias("text")))
    return F.filter(placed, lambda s, k: k % 2 == 1)


def none_of(kind: str = "array<struct<start:int,end:int,text:string>>") -> Column:
    return F.array().cast(kind)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a text of digits has a valid check digit."""
    total = F.aggregate(
        F.split(F.reverse(number), ""),
        F.struct(F.lit(0).alias("sum"), F.lit(0).alias("at")),
        lambda acc, digit: F.struct(
            (acc["sum"] + F.when(acc["at"] % 2 == 0, digit.cast("int")).otherwise(digit.cast("int") * 2 - F.when(digit.cast("int") > 4, 9).otherwise(0))).alias("sum"),
            (acc["at"] + 1).alias("at"),
        ),
        lambda acc: acc["sum"],
    )
    return F.when(F.length(number) > 0, total % 10 == 0).otherwise(F.lit(False))


def byte_parts(text: Column) -> Column:
    """Whether all numbers between dots are at most 255."""

    def small(part: Column) -> Column:
        bare = F.ltrim(part, F.lit("0"))
        return F.when(F.length(bare) <= 3, F.coalesce(F.concat(F.lit("0"), bare).cast("int"), F.lit(0)) <= 255).otherwise(F.lit(False))

    return F.forall(F.split(text, r"\."), small)


def between(number: Column, low: int, high: int) -> Column:
    return (F.length(number) >= low) & (F.length(number) <= high)


def with_base_spans(df: DataFrame, text: str) -> DataFrame:
    """``df`` with a column per kind: its spans (start, end, text) in order. ``text`` must be free of the marks."""
    has_digit = F.col(text).rlike("[0-9]")
    dotted = F.regexp_replace(text, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", JOINER)
    joined = F.regexp_replace(text, "(?<=[0-9])[ -](?=[0-9])", JOINER)
    sought = {
        "email": (F.contains(text, F.lit("@")), dotted, EMAIL),
        "ip": (has_digit, F.col(text), IP),
        "card": (has_digit, joined, CARD),
        "phone": (F.contains(text, F.lit("+")), F.col(text), PHONE),
    }
    for kind, (possible, source, pattern) in sought.items():
        df = df.withColumn(f"__parts_{kind}", F.when(possible, pieces(source, pattern)).otherwise(F.array(F.lit(""))))
    valid = {
        "email": lambda s: F.lit(True),
        "ip": lambda s: byte_parts(s["text"]),
        "card": lambda s: between(digits(s["text"]), 14, 19) & luhn(digits(s["text"])),
        "phone": lambda s: between(digits(s["text"]), 10, 15),
    }
    for kind in KINDS:
        found = F.filter(matches(F.col(f"__parts_{kind}")), valid[kind])
        df = df.withColumn(kind, found).drop(f"__parts_{kind}")
    return df


def with_candidates(df: DataFrame, text: str) -> DataFrame:
    """``df`` with a column ``candidates``: (kind, start, end, text, before, after) of all generators' spans.

    ``before`` and ``after`` reach to the generator's next span, ``CONTEXT`` signs at most.
    """
    possible = {
        "email": F.col(text).rlike(r"@|[\[(]at[\])]"),
        "number": F.col(text).rlike("[0-9]"),
        "account": F.col(text).rlike("[A-Z]{2}[0-9]{2}"),
    }

    def spans(kind: str) -> Column:
        parts = F.col(f"__parts_{kind}")
        count = ((F.size(parts) - 1) / 2).cast("int")
        between_them = F.filter(parts, lambda part, k: k % 2 == 0)
        found = F.arrays_zip(
            matches(parts).alias("span"), F.slice(between_them, F.lit(1), count).alias("left"), F.slice(between_them, F.lit(2), count).alias("right")
        )
        return F.transform(
            found,
            lambda s: F.struct(
                F.lit(kind).alias("kind"),
                s["span"]["start"].alias("start"),
                s["span"]["end"].alias("end"),
                s["span"]["text"].alias("text"),
                F.lower(F.right(s["left"], F.lit(CONTEXT))).alias("before"),
                F.left(s["right"], F.lit(CONTEXT)).alias("after"),
            ),
        )

    for kind, pattern in GENERATORS.items():
        df = df.withColumn(f"__parts_{kind}", F.when(possible[kind], pieces(F.col(text), pattern)).otherwise(F.array(F.lit(""))))
    long_enough = lambda c: (c["kind"] != "number") | (c["end"] - c["start"] >= SHORTEST_NUMBER)
    arrays = [F.filter(spans(kind), long_enough) for kind in GENERATORS]
    return df.withColumn("candidates", F.concat(*arrays)).drop(*[f"__parts_{k}" for k in GENERATORS])


def features(c: Column) -> list[Column]:
    """Form and context of a candidate, as numbers."""
    t = c["text"]
    flag = lambda x: F.coalesce(x.cast("double"), F.lit(0.0))
    count = lambda pattern: F.length(F.regexp_replace(t, f"[^{pattern}]", "")).cast("double")
    out = [
        F.length(t).cast("double"),
        count("0-9"),
        count("A-Za-z"),
        count(" "),
        count("."),
        count("-"),
        flag(t.startswith("+")),
        flag(F.contains(t, F.lit("("))),
        flag(F.contains(t, F.lit("@"))),
        count(":/"),
        flag(luhn(digits(t))),
        flag(c["before"].rlike(r"(?:mail|tel|phone|call|mobile|fax|card|visa|iban|account|konto|ssn|passport|address|ip)\W*$")),
        flag(c["before"].rlike(r"(?:^|[\s\"'(\[<:=,;])$")),
        flag(c["after"].rlike(r"^(?:$|[\s\"')\]>:=,;.!?])")),
    ]
    assert len(out) == FEATURES
    return out


def apart(candidates: Column, spans: Column) -> Column:
    """The candidates that overlap no span.

    Candidates by their end and spans by their start come into one order; a candidate overlaps if a span before it there ends
    after its start. Sorting and running maxima take n log n steps however many there are.
    """
    kind = "struct<kind:string,start:int,end:int,text:string,before:string,after:string>"
    ends = F.transform(candidates, lambda c: F.struct(c["end"].alias("at"), F.lit(0).alias("reach"), c.alias("c")))
    starts = F.transform(spans, lambda s: F.struct(s["start"].alias("at"), s["end"].alias("reach"), F.lit(None).cast(kind).alias("c")))
    order = F.array_sort(F.concat(ends, starts))  # at one place candidates come first, as their reach is 0
    reached = F.transform(F.arrays_zip(order.alias("e"), running(F.transform(order, lambda e: e["reach"]), lambda a, b: F.greatest(a, b)).alias("r")), lambda z: z)
    return F.transform(F.filter(reached, lambda z: z["e"]["c"].isNotNull() & (z["r"] <= z["e"]["c"]["start"])), lambda z: z["e"]["c"])


def like_base(sample: DataFrame) -> DataFrame:
    """(row, nth) of the candidates that a base span covers nearly all of. ``sample``: row, base, candidates.

    Spans meet through the cells of ``CELL`` signs that they lie in, so a text full of both makes no pairs of far ones.
    """

    def cells(start: Column, end: Column) -> Column:
        return F.explode(F.sequence((start / CELL).cast("int"), ((end - 1) / CELL).cast("int"))).alias("cell")

    spans = sample.select("row", F.explode("base").alias("s")).select("row", "s.start", "s.end", cells(F.col("s.start"), F.col("s.end")))
    found = sample.select("row", F.posexplode("candidates").alias("nth", "c"))
    found = found.select("row", "nth", F.col("c.start").alias("a"), F.col("c.end").alias("b"), cells(F.col("c.start"), F.col("c.end")))
    shared = F.least("end", "b") - F.greatest("start", "a")
    return found.join(spans, ["row", "cell"]).where(shared * 10 >= (F.greatest("end", "b") - F.least("start", "a")) * 9).select("row", "nth").distinct()


class Model:
    """Trees as nested tuples (feature, threshold, left, right) or leaf values, their weights, and a threshold per generator."""

    def __init__(self, trees: list, weights: list[float], thresholds: dict[str, float]):
        self.trees, self.weights, self.thresholds = trees, weights, thresholds

    def margin(self, values: list[Column]) -> Column:
        def walk(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            feature, threshold, left, right = node
            return F.when(values[feature] <= threshold, walk(left)).otherwise(walk(right))

        total = F.lit(0.0)
        for tree, weight in zip(self.trees, self.weights):
            total = total + walk(tree) * weight
        return total

    def selects(self, c: Column) -> Column:
        chosen = F.lit(False)
        margin = self.margin(features(c))
        for kind, threshold in self.thresholds.items():
            chosen = chosen | ((c["kind"] == kind) & (margin >= threshold))
        return chosen


def _tree(node) -> tuple | float:
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return int(split.featureIndex()), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild())


def fit(prepared: DataFrame, precision: float = PRECISION, rounds: int = 8) -> Model:
    """A model from rows (key, the base kinds, candidates); a third of them calibrates."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = prepared.where(F.size("candidates") > 0).select(
        F.monotonically_increasing_id().alias("row"), "key", F.concat(*[F.transform(k, lambda s: F.struct(s["start"], s["end"])) for k in KINDS]).alias("base"),
        "candidates",
    )
    rows = store(rows, "pii-rows")
    names = [f"f{i}" for i in range(FEATURES)]
    each = rows.select("row", "key", F.posexplode("candidates").alias("nth", "c"))
    right = like_base(rows).withColumn("label", F.lit(1.0))
    labelled = each.join(right, ["row", "nth"], "left").select(
        F.col("c.kind").alias("kind"), F.coalesce("label", F.lit(0.0)).alias("label"),
        (F.pmod(F.xxhash64("key"), F.lit(3)) == 0).alias("held"), *[f.alias(n) for n, f in zip(names, features(F.col("c")))],
    )
    sample = store(labelled, "pii-sample")
    sizes = {(bool(r[0]), r[1]): r[2] for r in sample.groupBy("held", "label").count().collect()}
    if not sizes.get((False, 0.0)) or not sizes.get((False, 1.0)):
        return Model([], [], {})
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(sample.where("not held"))
    fitted = GBTClassifier(labelCol="label", featuresCol="features", maxIter=rounds, maxDepth=3, maxBins=32, seed=1).fit(vectors)
    trees = [_tree(t._call_java("rootNode")) for t in fitted.trees]
    model = Model(trees, [float(w) for w in fitted.treeWeights], {})
    # calibration: the lowest margin above which enough held-back candidates are right, per generator
    margin = F.round(model.margin([F.col(n) for n in names]), 3)
    histogram = sample.where("held").groupBy("kind", margin.alias("margin")).agg(F.sum("label").alias("right"), F.count(F.lit(1)).alias("all"))
    by_kind: dict[str, list] = {}
    for r in histogram.collect():
        by_kind.setdefault(r["kind"], []).append((r["margin"], r["right"], r["all"]))
    for kind, bins in by_kind.items():
        right = every = 0
        for at, r, n in sorted(bins, reverse=True):
            right, every = right + r, every + n
            if every >= 20 and right >= precision * every:
                model.thresholds[kind] = at
    return model


def prepared(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(key, clean text) rows with base spans and candidates; marks in the text are replaced by a sign of the same length."""
    clean = F.translate(F.coalesce(F.col(text_column).cast("string"), F.lit("")), JOINER + MARK, SPARE + SPARE)
    rows = docs.select(F.col(id_column).alias("key"), clean.alias("clean"))
    return with_candidates(with_base_spans(rows, "clean"), "clean")


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", precision: float = PRECISION) -> DataFrame:
    """Per document: id, and ``spans``: (start, order of the kind, end, kind, base) sorted, ends exclusive, in code points."""
    model = fit(prepared(docs.select(id_column, text_column), id_column, text_column), precision)
    rows = prepared(docs, id_column, text_column)
    order = {kind: i for i, kind in enumerate([*KINDS, "number", "account"])}

    def span(s: Column, kind: str, base: bool) -> Column:
        return F.struct(s["start"].alias("start"), F.lit(order[kind]).alias("order"), s["end"].alias("end"), F.lit(kind).alias("kind"), F.lit(base).alias("base"))

    def all_spans(kind: str) -> Column:
        return F.transform(F.col(kind), lambda s: span(s, kind, True))

    base = F.concat(*[all_spans(kind) for kind in KINDS])
    rows = rows.withColumn("base", base)
    added = none_of("array<struct<start:int,order:int,end:int,kind:string,base:boolean>>")
    if model.thresholds:
        chosen = F.filter(apart(F.col("candidates"), F.col("base")), model.selects)
        added = F.transform(
            chosen,
            lambda c: F.struct(
                c["start"].alias("start"),
                F.when(c["kind"] == "email", order["email"]).when(c["kind"] == "number", order["number"]).otherwise(order["account"]).alias("order"),
                c["end"].alias("end"), c["kind"].alias("kind"), F.lit(False).alias("base"),
            ),
        )
    return rows.select(F.col("key").alias(id_column), F.array_sort(F.concat("base", added)).alias("spans"))


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """Numbers of base spans per kind, the digest of all base spans, and all spans."""
    found = find(docs, id_column, text_column, **options)
    base = F.filter("spans", lambda s: s["base"])

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        id_column,
        *[number(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
