"""Personal data: generated candidates, boosted trees over format and context, calibrated threshold.

Generators propose spans, which may overlap: the four base patterns (also where their checks fail) and wider ones
for numbers and addresses written out. Base matches that pass their checks (digit counts, Luhn, parts up to 255) are
always selected. The others are told apart by gradient boosted trees over the format and the surroundings, fitted on
all labelled candidates but those held back (`_steps`: no cut is drawn from a sample either). Labels come from
evidence that the trees do not see: passed and failed checks, words before the span that name its kind (`tel`, `mail`) or another one (`order`, `version`), dates and
numbers of digits. An address written out is looked at as the address that it spells, so it is scored like one.
The threshold of each kind is calibrated on all labelled candidates that were held back, three in ten: the lowest
score at which, by isotonic regression, at least `precision` of them are positive. Candidates of the wider generators at or above it are
added where no evidence speaks against them and they overlap neither a base span nor an earlier added one.

Everything is DataFrame code and Spark's own trees; positions are code points, the end exclusive.

Defined results: each row is a document, also where ids are null or rows repeat; null and empty texts have no spans.
Where the labelled candidates lack positives or negatives, no model is fitted and only base spans are returned; a kind
without labelled candidates gets no spans but its base ones. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.session import written

KINDS = ["email", "ip", "card", "phone"]
PRECISION, CONTEXT = 0.98, 24

# The base patterns. Possessive repeats find the same matches without trying again inside a run of characters.
# An address can only begin where a run of its characters begins, or where the last match ended (\G).
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Wider generators, with the kind that their spans get.
WIDER = {
    "international": ("phone", r"\+[0-9]{1,3}[\x20.-]?[(]?[0-9]{2,4}[)]?(?:[\x20.-]{1,2}[0-9]{2,5}){2,3}?(?![0-9])"),
    "run": ("card", r"(?<![0-9A-Za-z])[0-9]{13,19}+(?![0-9A-Za-z])"),
    "number": ("phone", r"(?<![0-9])[(]?[0-9]{2,4}[)]?(?:[\x20./-]{1,2}[(]?[0-9]{2,5}[)]?){2,5}+(?![0-9])"),
    "written": (
        "email",
        r"(?i)(?<![A-Z0-9._%+-])[A-Z0-9._%+-]++\x20?[(\[]\x20?at\x20?[)\]]\x20?[A-Z0-9-]++"
        r"(?:\x20?(?:\.|[(\[]\x20?dot\x20?[)\]])\x20?[A-Z0-9-]++)++",
    ),
}
# Only examples of what is no address.
LOOSE = {"loose": ("email", r"(?<![A-Za-z0-9._%+@-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]*+(?![A-Za-z0-9.@-])")}
# What a text must hold for a generator to be worth running.
_NEEDS = {"email": "@", "ip": r"\.", "phone": r"\+", "international": r"\+", "written": r"(?i)[(\[]\x20?at\x20?[)\]]", "loose": "@"}
_GENERATORS = {**{k: (k, p) for k, p in BASE.items()}, **WIDER, **LOOSE}
# Those whose candidates the trees decide on.
SCORED = ["international", "number", "written"]

# Evidence for labels. Words before a span that name its kind, or something else.
_NAMED = {
    "phone": r"(?i)\b(?:tel|telephone|telefon|phone|call|fax|mobile|mob|cell|ring)\b[^A-Za-z]{0,3}$",
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|reach)\b(?:\x20(?:to|us|me|at))?[^A-Za-z]{0,3}$",
}
_OTHER = r"(?i)\b(?:token|key|id|sha|hash|version|ver|no|page|order|isbn|invoice|ref|serial)\b[^A-Za-z]{0,4}$"
_DATE = r"^(?:[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)?[0-9]{2}|(?:19|20)[0-9]{2}[./-][0-9]{1,2}[./-][0-9]{1,2})$"


def _found(text: Column, pattern: str, worth: Column) -> Column:
    """Matches of a pattern with the code points since the last match and the text around, null if none."""
    gaps = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # Zipped, as an array named inside a lambda would be made anew for every match.
    zipped = F.arrays_zip(matches.alias("value"), gaps.alias("gap"), F.slice(gaps, 2, 1 << 30).alias("next"))
    packed = F.transform(
        F.filter(zipped, lambda z: z["value"].isNotNull()),
        lambda z: F.struct(
            F.char_length(z["gap"]).alias("gap"),
            z["value"].alias("value"),
            F.right(z["gap"], F.lit(CONTEXT)).alias("before"),
            F.left(z["next"], F.lit(CONTEXT)).alias("after"),
        ),
    )
    return F.when(worth & F.col("_text").rlike(pattern), packed)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit holds: from the right, every second digit is doubled and its digits added."""
    total = F.aggregate(
        F.transform(
            F.split(F.reverse(digits), ""),
            lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
                (d.cast("int") * 2) - F.when(d.cast("int") > 4, 9).otherwise(0)
            ),
        ),
        F.lit(0),
        lambda a, d: a + F.coalesce(d, F.lit(0)),
    )
    return total % 10 == 0


def _passes(generator: Column, value: Column) -> Column:
    digits = _digits(value)
    count = F.length(digits)
    parts = F.forall(F.split(value, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.right(p, F.lit(3)).cast("int") <= 255))
    return (
        F.when(generator == "email", F.lit(True))
        .when(generator == "ip", parts)
        .when(generator == "card", count.between(12, 19) & _luhn(digits))
        .when(generator == "phone", count.between(9, 15))
        .otherwise(F.lit(False))
    )


def candidates(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """All rows (`row`, `id`), and the candidate spans: `row`, `generator`, `kind`, `value`, `before`, `after`,
    `start`, `end` and `base` (a base match that passes its checks)."""
    named = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    has_digits = F.col("_text").rlike("[0-9]")
    found = {
        name: _found(F.col("_text"), pattern, F.col("_text").rlike(_NEEDS[name]) if name in _NEEDS else has_digits)
        for name, (_, pattern) in _GENERATORS.items()
    }
    # The row number is fixed by writing it: a retried task can't change what was committed.
    scanned = named.select(F.monotonically_increasing_id().alias("row"), "id", *[c.alias(n) for n, c in found.items()])
    scanned = written(scanned, "candidates")
    each = [
        scanned.where(F.col(name).isNotNull()).select("row", F.lit(name).alias("generator"), F.lit(kind).alias("kind"), F.posexplode(name).alias("at", "m"))
        for name, (kind, _) in _GENERATORS.items()
    ]
    spans = each[0]
    for more in each[1:]:
        spans = spans.unionByName(more)
    before = Window.partitionBy("row", "generator").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("m.gap") + F.char_length("m.value")).over(before), F.lit(0)) + F.col("m.gap")
    spans = spans.withColumn("start", start).select(
        "row", "generator", "kind", "m.value", "m.before", "m.after", "start",
        (F.col("start") + F.char_length("m.value")).alias("end"),
        _passes(F.col("generator"), F.col("m.value")).alias("base"),
    )
    # Fewer than eight digits on their own are no candidate for a card.
    spans = spans.where((F.col("generator") != "card") | (F.length(_digits(F.col("value"))) >= 8))
    return scanned.select("row", "id"), spans


def _features(value: Column, before: Column, after: Column) -> dict[str, Column]:
    count = lambda what: F.length(F.regexp_replace(value, f"[^{what}]", "")).cast("double")
    is_in = lambda text, what: text.rlike(what).cast("double")
    groups = F.filter(F.split(value, "[^0-9]+"), lambda g: g != "")
    sizes = F.transform(groups, F.length)
    return {
        "length": F.char_length(value).cast("double"),
        "digits": count("0-9"),
        "letters": count("A-Za-z"),
        "dots": count("."),
        "dashes": count(r"\-"),
        "spaces": count(r"\x20"),
        "parentheses": count("()"),
        "groups": F.size(groups).cast("double"),
        "longest": F.coalesce(F.array_max(sizes), F.lit(0)).cast("double"),
        "shortest": F.coalesce(F.array_min(sizes), F.lit(0)).cast("double"),
        "plus": is_in(value, r"^\+"),
        "zero": is_in(value, r"^[(]?0"),
        "at": is_in(value, "@"),
        "glued_before": is_in(before, r"[A-Za-z0-9_.+-]$"),
        "glued_after": is_in(after, r"^[A-Za-z0-9_-]"),
        "quoted": is_in(before, "[\"'=]\\x20?$"),
        "words_before": is_in(before, r"[^\W\d_]{2,}[\x20,.:]+$"),
    }


# Counts are told apart at these values, flags at the first.
_CUTS = (*range(1, 17), 18, 20, 24, 28, 32, 40, 48, 64)
_FLAGS = ("plus", "zero", "at", "glued_before", "glued_after", "quoted", "words_before")


def _steps(x: Column) -> Column:
    """The trees' features: for each number of `x` and each cut whether it is reached; the flags come last.

    They are declared binary, as Spark would look for the cuts of numbers in a sample of the rows.
    """
    cuts = F.array(*[F.lit(float(c)) for c in _CUTS])
    reached = F.flatten(F.transform(F.slice(x, 1, F.size(x) - len(_FLAGS)), lambda n: F.transform(cuts, lambda c: (n >= c).cast("double"))))
    return array_to_vector(F.concat(reached, F.slice(x, -len(_FLAGS), len(_FLAGS))))


def _with_steps(frame: DataFrame, numbers: int) -> DataFrame:
    count = (numbers - len(_FLAGS)) * len(_CUTS) + len(_FLAGS)
    binary = {"ml_attr": {"attrs": {"binary": [{"idx": i} for i in range(count)]}, "num_attrs": count}}
    return frame.withColumn("features", _steps(F.col("x"))).withMetadata("features", binary)


def _spelled(generator: Column, value: Column) -> Column:
    """What a value stands for: an address written out as the address."""
    plain = value
    for word, sign in (("at", "@"), ("dot", ".")):
        plain = F.regexp_replace(plain, rf"(?i)\x20?[(\[]\x20?{word}\x20?[)\]]\x20?", sign)
    return F.when(generator == "written", plain).otherwise(value)


def _labelled(spans: DataFrame) -> DataFrame:
    """Spans with `overlaps` (they overlap a base span of their document) and `label`: 1, 0, or null where nothing is
    known."""
    by_start = Window.partitionBy("row").orderBy("start", "end")
    earlier, later = by_start.rowsBetween(Window.unboundedPreceding, -1), by_start.rowsBetween(1, Window.unboundedFollowing)
    base_end, base_start = F.when(F.col("base"), F.col("end")), F.when(F.col("base"), F.col("start"))
    overlaps = (F.col("start") < F.coalesce(F.max(base_end).over(earlier), F.lit(-1))) | (
        F.col("end") > F.coalesce(F.min(base_start).over(later), F.lit(1 << 40))
    )
    spans = spans.withColumn("overlaps", F.col("base") | overlaps)
    digits = F.length(_digits(F.col("value")))
    unlike = (F.col("kind") == "phone") & (~digits.between(9, 15) | F.col("value").rlike(_DATE))
    named = F.lit(False)
    for kind, words in _NAMED.items():
        named = named | ((F.col("kind") == kind) & F.col("before").rlike(words))
    label = (
        F.when(F.col("overlaps"), 1.0)
        .when(~F.col("generator").isin(SCORED) | unlike | F.col("before").rlike(_OTHER), 0.0)
        .when(named, 1.0)
    )
    return spans.withColumn("label", label)


def _fit(assembled: DataFrame, numbers: int, precision: float) -> tuple[GBTClassificationModel, dict[str, float]] | None:
    """Trees, and thresholds by kind, from all labelled candidates, three in ten of them held back.

    Candidates of the same features, kind and label are one row with their number as its weight.
    """
    known = assembled.where("label IS NOT NULL")
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(3), "row", "start", "end", "generator"), 11) / F.lit(float(1 << 53))
    folded = known.groupBy("x", "label", "kind", (drawn >= 0.7).alias("held"))
    folded = _with_steps(written(folded.agg(F.count("*").cast("double").alias("weight")), "labelled"), numbers)
    fitting, held = folded.where("NOT held"), folded.where("held")
    if {r["label"] for r in fitting.select("label").distinct().collect()} != {0.0, 1.0}:
        return None
    model = GBTClassifier(maxIter=12, maxDepth=3, stepSize=0.3, seed=1, weightCol="weight").fit(fitting.select("features", "label", "weight"))
    scored = model.transform(held).select(vector_to_array("probability")[1].alias("p"), "label", "kind", "weight")
    # One row per score, with its share of positives.
    shares = (F.sum(F.col("label") * F.col("weight")) / F.sum("weight")).alias("label")
    scored = written(scored.groupBy("kind", "p").agg(shares, F.sum("weight").alias("weight")), "held-back")
    thresholds = {}
    for kind in sorted({WIDER[generator][0] for generator in SCORED}):
        own = scored.where(F.col("kind") == kind)
        if own.isEmpty():
            continue
        # Shares of positives by score, made monotone: the probability at a score, not of all above it.
        calibrated = IsotonicRegression(featuresCol="p", labelCol="label", weightCol="weight").fit(own)
        shares = zip(calibrated.boundaries.toArray().tolist(), calibrated.predictions.toArray().tolist())
        found = [p for p, share in shares if share >= precision]
        if found:
            thresholds[kind] = min(found)
    return (model, thresholds) if thresholds else None


def personal_data(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    precision: float = PRECISION,
) -> DataFrame:
    """Per row of `docs`: `id` and `spans`, an array of `start`, `order` (place of the kind in `KINDS`), `kind`, `end`
    and `base`, sorted by start and kind."""
    rows, spans = candidates(docs, doc_id, text)
    spans = _labelled(spans)
    features = _features(_spelled(F.col("generator"), F.col("value")), F.col("before"), F.col("after"))
    numbers = F.array(*[features[name] for name in features if name not in _FLAGS], *[features[name] for name in _FLAGS])
    spans = written(spans.withColumn("x", numbers).drop("before", "after", "value"), "scorable")
    selected = spans.where("base")
    if fitted := _fit(spans, len(features), precision):
        model, thresholds = fitted
        open_ones = spans.where(F.col("generator").isin(SCORED) & ~F.col("overlaps") & F.coalesce(F.col("label") > 0, F.lit(True)))
        least = F.create_map(*[F.lit(x) for pair in thresholds.items() for x in pair])[F.col("kind")]
        scored = model.transform(_with_steps(open_ones, len(features))).where(vector_to_array("probability")[1] >= least).select(*selected.columns)
        # Of overlapping candidates the first stays, of those that begin together the longest.
        earlier = Window.partitionBy("row").orderBy("start", F.desc("end"), "generator").rowsBetween(Window.unboundedPreceding, -1)
        scored = scored.withColumn("reach", F.max("end").over(earlier))
        selected = selected.unionByName(scored.where("reach IS NULL OR start >= reach").drop("reach"))
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    packed = F.struct("start", order.alias("order"), "kind", "end", "base")
    grouped = selected.groupBy("row").agg(F.array_sort(F.collect_list(packed)).alias("spans"))
    return rows.join(grouped, "row", "left").select(
        "id", F.coalesce("spans", F.array().cast(grouped.schema["spans"].dataType)).alias("spans")
    )


def joined(spans: Column) -> Column:
    """`kind:start:end` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
