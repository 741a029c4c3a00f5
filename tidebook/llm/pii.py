"""Personal data by candidate gradient boosting, in DataFrame functions throughout.

Exact patterns give the base spans (email, ip, card, phone), each kind leftmost and non-overlapping.
Wider generators propose further, overlapping candidates for each kind: addresses with spelled-out
signs, numbers in loose card and phone formats, colon-separated addresses. Boosted trees score each
candidate from its format and context. They are fitted on a bounded sample (about SAMPLE rows, by kind
and label) of: verified candidates (those that touch a base span of their kind) and the same rewritten
in formats that the exact patterns do not take, as positives; verified ones broken so that they are
no address or number any more, and at a low weight all other candidates, as negatives. A kind's threshold is calibrated
on the verified and rewritten candidates of documents kept out of the fit, all of them: all but MISSED
of these pass it, and it is LEAST at least. Candidates above it that touch no base span, and no better
candidate, are added; base spans stay.

The trees are turned into SQL expressions, so that finding and redacting is a map over the rows: no
exchange, no Python. Spans of a kind are sorted and apart, so what touches a span is found by bisection.

Offsets are code points, end exclusive. Defined results: a null text has no spans; repeated rows each
get a row; equal scores go to the longer candidate, then to the earlier kind and the earlier start;
without verified spans to learn from nothing is added; a very long text is one value, whose offsets are
summed in blocks; an empty table gives an empty result; other columns are kept by redact() and ignored by find().
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.llm.common import materialize

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 20_000
TREES, DEPTH, RATE = 16, 4, 0.4
KEPT_OUT = 4  # one in so many documents is left out of the fit, to calibrate on
MISSED = 0.05  # share of the calibrating positives that a threshold lets go
LEAST = 0.5  # the lowest threshold
UNSURE = 0.1  # weight of a candidate that is not verified, which may be personal data all the same
CONTEXT = 24  # characters of left context that features see
BLOCK = 256  # values that a running sum or maximum takes at once

# Possessive and look-behind forms of the contract's patterns: same matches, linear time and no deep recursion.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++(?:@|[ ]?[\[(](?:at|AT)[\])][ ]?)[A-Za-z0-9-]++(?:(?:\.|[ ]?[\[(](?:dot|DOT)[\])][ ]?)[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9A-Za-z.:])(?:[0-9]{1,4}(?:\.[0-9]{1,4}){3,5}+|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7}+)(?![0-9A-Za-z])",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+|00)?\(?[0-9](?:[ ().-]{0,2}[0-9]){6,14}+(?![0-9A-Za-z])",
}
MAYBE = {  # cheap tests that a text must pass before the patterns above are tried
    "email": r"@|[\[(](?:at|AT)[\])]",
    "ip": r"[0-9A-Fa-f][.:]",
    "card": r"[0-9]",
    "phone": r"[0-9]",
}
WORDS = {  # fixed values: context words of each kind
    "email": "mail|contact|write|reach",
    "ip": "ip|host|server|address|login",
    "card": "card|visa|credit|account|iban|konto|tarjeta|carte",
    "phone": "tel|phone|call|fax|mobile|ruf",
}


def _running(values: Column, most: bool = False) -> Column:
    """Running sums, or maxima, of an array of longs, in one pass and in blocks, so that long arrays are not copied at each step."""
    none, blocks = F.expr("cast(array() as array<bigint>)"), F.expr("cast(array() as array<array<bigint>>)")
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("part"), blocks.alias("out"))

    def add(acc, x):
        now = F.greatest(acc["at"], x) if most else acc["at"] + x
        part = F.concat(acc["part"], F.array(now))
        full = F.size(acc["part"]) + 1 >= BLOCK
        return F.struct(now.alias("at"), F.when(full, none).otherwise(part).alias("part"), F.when(full, F.concat(acc["out"], F.array(part))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(values, zero, add, lambda acc: F.flatten(F.concat(acc["out"], F.array(acc["part"]))))


def _spans(docs: DataFrame, text: Column, maybe: Column, pattern: str, context: bool, into: str) -> DataFrame:
    """docs with into: the leftmost non-overlapping matches as array<struct<s,e,m,l,r>>: offsets, match, left and right context.

    Each step is a column of its own, and no function of an element looks at a whole array: texts are matched once.
    """
    docs = docs.withColumn("_m", F.when(maybe, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.expr("cast(array() as array<string>)")))
    docs = docs.withColumn("_p", F.when(F.size("_m") > 0, F.split(text, pattern, -1)).otherwise(F.array(F.lit(""))))
    docs = docs.withColumn("_z", F.arrays_zip(F.col("_m").alias("m"), F.slice("_p", 1, F.size("_m")).alias("p"), F.slice("_p", 2, F.size("_m")).alias("q")))
    ends = _running(F.transform("_z", lambda x: (F.length(x["p"]) + F.length(x["m"])).cast("bigint")))

    def span(x, end):
        left = F.substring(x["p"], -CONTEXT, CONTEXT) if context else F.lit("")
        right = F.substring(x["q"], 1, 8) if context else F.lit("")
        return F.struct((end - F.length(x["m"])).alias("s"), end.alias("e"), x["m"].alias("m"), left.alias("l"), right.alias("r"))

    return docs.withColumn(into, F.zip_with("_z", ends, span)).drop("_m", "_p", "_z")


def _below(spans: Column, limit: Column, of: str) -> Column:
    """How many of the sorted spans have their start or end (of) before or at limit's side, by bisection."""
    steps = F.expr("array(" + ",".join(str(1 << k) for k in reversed(range(27))) + ")")
    less = (lambda x: x["s"] < limit) if of == "s" else (lambda x: x["e"] <= limit)
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(less(F.get(spans, at + step - 1)), at + step).otherwise(at))


def _touching(spans: Column, c: Column) -> Column:
    """Those of the sorted spans, which are apart from each other, that share a character with c."""
    first = _below(spans, c["s"], "e")
    return F.slice(spans, first + 1, F.greatest(_below(spans, c["e"], "s") - first, F.lit(0)))


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn check."""
    n = F.length(digits)

    def value(i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when((n - i) % 2 == 1, twice).otherwise(d)

    places = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))
    return F.aggregate(F.transform(places, value), F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        small = lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3
        return F.forall(F.split(m, r"\."), lambda p: small(p) & (F.substring(F.concat(F.lit("00"), p), -3, 3).cast("int") <= 255))
    if kind == "card":
        return _luhn(_digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    return F.lit(True)


def _features(k: Column, m: Column, left: Column, right: Column) -> Column:
    """Format and context features of a candidate m of kind number k, as array<double>."""
    digits, near = _digits(m), F.lower(left)
    n = F.length(digits)
    values = [
        *[k == i for i in range(len(KINDS))],
        F.length(m),
        n,
        n / F.length(m),
        F.length(F.regexp_replace(m, r"[^ .()-]", "")),
        m.contains("@"),
        m.startswith("+"),
        F.length(F.regexp_replace(m, r"[^.]", "")),
        F.length(F.regexp_replace(m, r"[^:]", "")),
        m.rlike(r"(?i)(?:@|[\[(]at[\])]).*(?:\.|[\[(]dot[\])])"),
        m.rlike(r"(?i)[\[(](?:at|dot)[\])]"),
        n.between(13, 19) & _luhn(digits),
        m.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.|$)){4}$"),
        left.rlike(r"[A-Za-z0-9]$"),
        left.rlike(r"[\"'=/]$"),
        right.rlike(r"^[A-Za-z0-9]"),
        right.rlike(r"^[\"'=/%]"),
        *[near.rlike(rf"\b(?:{WORDS[kind]})") for kind in KINDS],
    ]
    return F.array(*[F.coalesce(v.cast("double"), F.lit(0.0)) for v in values])


def _rewritten(k: Column, m: Column) -> Column:
    """Other formats (label 1) and broken forms (label 0) of a verified candidate, as array<struct<m,label>>."""
    digits = _digits(m)
    stem = F.substring(digits, F.lit(1), F.lit(14))
    check = F.expr("array('0','1','2','3','4','5','6','7','8','9')")
    amex = F.concat(stem, F.element_at(F.filter(check, lambda d: _luhn(F.concat(stem, d))), 1))
    wrong = F.concat(F.substring(digits, F.lit(1), F.length(digits) - 1), ((F.substring(digits, -1, 1).cast("int") + 1) % 10).cast("string"))
    forms = {
        "email": ([F.regexp_replace(m, "@", "(at)"), F.regexp_replace(F.regexp_replace(m, "@", "(at)"), r"\.(?=[A-Za-z0-9-]+$)", "(dot)"), F.regexp_replace(F.regexp_replace(m, "@", " [at] "), r"\.(?=[A-Za-z0-9-]+$)", " [dot] ")], [F.regexp_extract(m, r"^[^@(\[]*@?[A-Za-z0-9-]+", 0)]),
        "ip": ([F.regexp_replace(m, r"(?<![0-9])(?=[0-9]\.)", "00")], [F.regexp_replace(m, "^[0-9]+", "999"), F.concat(m, F.lit(".1.2"))]),
        "card": ([F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", "$1 "), amex], [wrong]),
        "phone": ([F.regexp_replace(m, r"^[+]", ""), F.regexp_replace(m, r"^[+]", "00"), F.regexp_replace(m, "[ ().-]+", "-")], []),
    }
    out = F.expr("cast(array() as array<struct<m:string,label:double>>)")
    for i, kind in enumerate(KINDS):
        made = [F.struct(x.alias("m"), F.lit(float(y)).alias("label")) for y, xs in zip((1, 0), forms[kind]) for x in xs]
        out = F.when(k == i, F.array(*made)).otherwise(out)
    return out


def annotate(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with, for each kind k, _b<k> (its base spans: s, e) and _c<k> (its candidates: s, e, m, l, r, whether verified)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    for k, kind in enumerate(KINDS):
        docs = _of_kind(docs, text, k, kind)
    return docs


def _of_kind(docs: DataFrame, text: Column, k: int, kind: str) -> DataFrame:
    maybe = text.rlike(MAYBE[kind])
    docs = _spans(docs, text, maybe, BASE[kind], False, f"_b{k}")
    docs = docs.withColumn(f"_b{k}", F.transform(F.filter(f"_b{k}", lambda x: _valid(kind, x["m"])), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))))
    docs = _spans(docs, text, maybe, WIDE[kind], True, f"_c{k}")
    verified = lambda x: (F.size(_touching(F.col(f"_b{k}"), x)) > 0).alias("y")
    return docs.withColumn(f"_c{k}", F.transform(f"_c{k}", lambda x: F.struct(*[x[c].alias(c) for c in ("s", "e", "m", "l", "r")], verified(x))))


def _numbered(spans: str, k: int, *fields: str) -> Column:
    """Spans with the number of their kind before the fields."""
    return F.transform(spans, lambda x: F.struct(F.lit(k).alias("k"), *[x[c].alias(c) for c in fields]))


class Model:
    """Boosted trees as a SQL expression over x.f, and a threshold for each kind."""

    def __init__(self, margin: str | None = None, thresholds: tuple[float, ...] = ()):
        self.margin, self.thresholds = margin, thresholds

    def probability(self, x: str) -> str:
        return f"(1.0D / (1.0D + exp(-2.0D * ({self.margin.replace('x.f', x + '.f')}))))"


def _tree(node) -> str:
    if node.getClass().getSimpleName() == "LeafNode":
        return f"{node.prediction()!r}D"
    cut = node.split()
    return f"CASE WHEN x.f[{cut.featureIndex()}] <= {cut.threshold()!r}D THEN {_tree(node.leftChild())} ELSE {_tree(node.rightChild())} END"


def examples(annotated: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(fold, k, label, trust, f): candidates as found, and the rewritten forms of verified ones; fold 0 is kept out of the fit."""
    marked = [_numbered(f"_c{k}", k, *"smlry") for k in range(len(KINDS))]
    every = annotated.select(F.col(id_col).alias("id"), F.explode(F.concat(*marked)).alias("x"))
    own = F.array(F.struct(F.col("x.m").alias("m"), F.col("x.y").cast("double").alias("label")))
    forms = F.when(F.col("x.y"), F.concat(own, _rewritten(F.col("x.k"), F.col("x.m")))).otherwise(own)
    every = every.select("id", "x", F.posexplode(forms).alias("form", "v"))
    fold = F.pmod(F.xxhash64("id"), F.lit(KEPT_OUT))
    return every.select(
        fold.alias("fold"), F.col("x.k").alias("k"), F.col("v.label").alias("label"), F.when((F.col("form") == 0) & ~F.col("x.y"), UNSURE).otherwise(1.0).alias("trust"), F.xxhash64("id", "x.s", "x.k", "form").alias("draw"),
        _features(F.col("x.k"), F.col("v.m"), F.col("x.l"), F.col("x.r")).alias("f"),
    )


def train(annotated: DataFrame, id_col: str = "doc_id", sample: int = SAMPLE) -> Model:
    """Fit the trees on about sample examples of a written, annotated table; calibrate on all that are kept out.

    The sample is drawn by kind and label, so that no rare one vanishes, and weighted back to the whole.
    """
    every = examples(annotated, id_col)
    sizes = {(r["k"], r["label"]): r["n"] for r in every.filter("fold <> 0").groupBy("k", "label").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        every = every.withColumn("fold", F.lit(1))
        sizes = {(r["k"], r["label"]): r["n"] for r in every.groupBy("k", "label").agg(F.count("*").alias("n")).collect()}
    rate = F.lit(1.0)
    for (k, label), m in sizes.items():
        rate = F.when((F.col("k") == k) & (F.col("label") == label), min(1.0, sample / len(sizes) / m)).otherwise(rate)
    rows = every.filter("fold <> 0").withColumn("rate", rate).filter(F.pmod("draw", F.lit(1 << 40)) < F.col("rate") * (1 << 40))
    rows = materialize(rows.select("f", "label", (F.col("trust") / F.col("rate")).alias("weight")).coalesce(2), "pii-sample")
    seen = {r["label"] for r in rows.select("label").distinct().collect()}
    if seen != {0.0, 1.0}:
        return Model() if 1.0 not in seen else Model("1.0D", (LEAST,) * len(KINDS))
    gbt = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, seed=7, featuresCol="features", labelCol="label", weightCol="weight")
    fitted = gbt.fit(rows.select("label", "weight", array_to_vector("f").alias("features")))
    weights = fitted.treeWeights
    java = fitted._java_obj.trees()
    margin = " + ".join(f"{w!r}D * ({_tree(java[i].rootNode())})" for i, w in enumerate(weights))
    model = Model(margin)
    score = F.expr(model.probability("x"))
    right = every.filter("label = 1").select("k", (F.col("fold") == 0).alias("out"), F.struct("f").alias("x")).withColumn("p", score)
    lows = {(r["k"], r["out"]): r["low"] for r in right.groupBy("k", "out").agg(F.percentile_approx("p", MISSED, 10_000).alias("low")).collect()}
    # A kind that no document kept out has is calibrated on the others; one without verified spans adds none.
    model.thresholds = tuple(max(LEAST, float(lows.get((k, True), lows.get((k, False), 2.0)))) for k in range(len(KINDS)))
    return model


def add_spans(annotated: DataFrame, model: Model) -> DataFrame:
    """annotated with _base and _spans (k, s, e): the base spans, and those with the added ones, by kind and start."""
    kinds = range(len(KINDS))
    out = annotated.withColumn("_base", F.array_sort(F.concat(*[_numbered(f"_b{k}", k, "s", "e") for k in kinds])))
    if model.margin is None:
        return out.withColumn("_spans", F.col("_base"))
    for k in kinds:
        out = out.withColumn(f"_f{k}", _free(k))
        out = out.withColumn(f"_f{k}", F.expr(f"filter(transform(_f{k}, c -> named_struct('s', c.s, 'e', c.e, 'p', {model.probability('c')})), c -> c.p >= {model.thresholds[k]!r}D)"))
    for k in kinds:
        out = out.withColumn(f"_a{k}", _best(k))
    added = [_numbered(f"_a{k}", k, "s", "e") for k in kinds]
    return out.withColumn("_spans", F.array_sort(F.concat("_base", *added))).drop(*[f"_{c}{k}" for k in kinds for c in "fa"])


def _free(k: int) -> Column:
    """The candidates of a kind that touch no base span, with their features."""

    def free(c):
        touched = F.lit(False)
        for j in range(len(KINDS)):
            touched = touched | (F.size(_touching(F.col(f"_b{j}"), c)) > 0)
        return ~c["y"] & ~touched

    return F.transform(F.filter(f"_c{k}", free), lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), _features(F.lit(k), c["m"], c["l"], c["r"]).alias("f")))


def _best(k: int) -> Column:
    """Of the scored candidates of all kinds that touch, the best one stays: higher score, then longer, then earlier kind and start."""

    def value(c, j):
        return F.struct(c["p"].alias("p"), (c["e"] - c["s"]).alias("n"), F.lit(-j).alias("k"), (-c["s"]).alias("s"))

    def beaten_by(c, j):
        return F.exists(_touching(F.col(f"_f{j}"), c), lambda d: value(d, j) > value(c, k))

    def best(c):
        beaten = F.lit(False)
        for j in range(len(KINDS)):
            beaten = beaten | beaten_by(c, j)
        return ~beaten

    return F.filter(f"_f{k}", best)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, _base, _spans) for every row."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = materialize(annotate(src).drop("text"), "pii-candidates")
    return add_spans(found, train(found)).select("doc_id", "_base", "_spans")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with every span of text_col replaced by its kind in brackets, the earliest, then longest of those that overlap; other columns are kept."""
    # The row travels as one value, so that its other columns may have any names.
    packed = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = materialize(annotate(packed), "pii-candidates")
    spans = add_spans(found, train(found.drop("_row", "text")))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    order = F.array_sort(F.transform("_spans", lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("far"), x["k"].alias("k"), x["e"].alias("e"))))
    spans = spans.withColumn("_order", order)
    spans = spans.withColumn("_past", F.concat(F.array(F.lit(0).cast("bigint")), _running(F.transform("_order", lambda x: x["e"]), most=True)))
    text, past = F.col("text"), F.col("_past")

    def piece(x, i):
        """What lies between the spans before and this one, and its name unless it starts inside one of them."""
        gap = F.greatest(F.lit(0).cast("bigint"), x["s"] - F.get(past, i)).cast("int")
        return F.concat(F.substring(text, (F.get(past, i) + 1).cast("int"), gap), F.when(x["s"] >= F.get(past, i), F.element_at(names, x["k"] + 1)).otherwise(""))

    rest = F.substring(text, (F.element_at("_past", -1) + 1).cast("int"), F.lit(2**31 - 1))
    clean = F.when(F.size("_order") > 0, F.concat(F.array_join(F.transform("_order", piece), ""), rest)).otherwise(text)
    return spans.select(F.col("_row").withField(text_col, clean).alias("_row")).select("_row.*")
