"""Personal data in documents: exact patterns, and boosted trees over wider candidates.

Everything here is DataFrame work: no Python runs on the executors.

* Base spans: e-mail, ip, card and phone numbers by exact patterns and checks.
* Candidates: wider patterns find addresses and runs of numbers. Every part of a run that begins and ends with a
  group of digits is proposed as each kind that its digits fit, so proposals overlap and neighbouring numbers are told apart. Each carries features of its format (digits,
  groups, separators, signs) and of its context (the characters and words beside it).
* The trees are fitted with ``pyspark.ml`` on all distinct feature vectors, weighted by how many distinct values have
  them, so repeated rows change nothing. Nothing is drawn from them: ``sample`` only scales weights, of which a kind has
  no more than a quarter of it. An address that overlaps a base span is a positive, and so is a number that is a base span of its kind; so is a copy
  with its telltale sign taken away, or the trees would only look for that sign; other proposals are negatives, and
  so are numbers in common formats that are no personal data (dates, amounts, versions, book numbers). Not judged are the
  ends of base spans, which may be such copies, and parts of runs that would be base spans if they stood alone.
* A third of the values is set apart. Per kind, the threshold is the lowest score that keeps
  a precision of ``precision`` there; a kind without enough examples adds nothing.
* The fitted trees become one column expression over a document's proposals. Those above their
  threshold that overlap no base span are added from the best on, unless they overlap one added before.

Positions come from the text between matches, whose lengths are summed in two
levels, so long texts with many matches take time in proportion.

Defined cases: null texts are empty; empty texts have no spans; rows that share an id
are judged each; matches that fail a check are dropped and not searched again; no text is cut.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from stockline.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
# The given patterns. Possessive quantifiers and a look at the character before give the same leftmost matches
# without trying the rest of a word again at each of its letters.
_NAME = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++"
BASE = {
    "email": _NAME + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
WIDE_EMAIL = (r"(?i)" + _NAME + r"(?: ?@ ?| ?[\[(]at[\])] ?)[A-Za-z0-9-]++(?:(?: ?\. ?| ?[\[(]dot[\])] ?)[A-Za-z0-9-]++)++")
WIDE_NUMBER = r"[+(]?[0-9](?:[ ()./\[\]-]{0,3}[0-9])++"
MOST_DIGITS = 19  # of any kind of number
FEATURES = ("kind", "chars", "digits", "groups", "longest", "first", "last", "signs", "plus", "paren", "at", "dots", "hyphens", "letters",
            "before_word", "before_digit", "before_sign", "after_word", "after_digit", "after_sign", "cue_phone", "cue_mail", "cue_net", "cue_card", "line_start", "check")


def _prefix(lengths: Column, start: Column) -> Column:
    """``start`` plus the sum of all lengths before each."""
    zero = F.struct(start.cast("int").alias("at"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(lengths, zero, lambda acc, x: F.struct((acc["at"] + x).cast("int").alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]


def _offsets(lengths: Column, step: int = 256) -> Column:
    """Sums of the lengths before each, in parts of ``step``."""
    parts = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(lengths) / step).cast("int") - 1, F.lit(0))), lambda i: F.slice(lengths, i * step + 1, step))
    heads = _prefix(F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda a, x: a + x)), F.lit(0))
    return F.flatten(F.zip_with(parts, heads, _prefix))


def _matches(df: DataFrame, name: str, pattern: str, may: Column) -> DataFrame:
    """``df`` with array ``name`` of (start, value, before, after) of all matches in ``text``."""
    hits, gaps, at = f"_{name}_hits", f"_{name}_gaps", f"_{name}_at"
    df = df.withColumn(hits, F.when(may, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))))
    df = df.withColumn(gaps, F.when(F.size(hits) > 0, F.split("text", pattern, -1)))
    df = df.withColumn(at, _offsets(F.zip_with(gaps, hits, lambda g, h: F.length(g) + F.coalesce(F.length(h), F.lit(0)))))
    rows = F.transform(F.col(hits), lambda h, i: F.struct(
        (F.get(at, i) + F.length(F.get(gaps, i))).alias("start"), h.alias("value"), F.right(F.get(gaps, i), F.lit(24)).alias("before"),
        F.left(F.get(gaps, i + 1), F.lit(24)).alias("after")))
    empty = F.array().cast("array<struct<start: int, value: string, before: string, after: string>>")
    return df.withColumn(name, F.when(F.size(hits) > 0, rows).otherwise(empty)).drop(hits, gaps, at)


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    return {
        "email": F.lit(True),
        "ip": value.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})){3}$"),
        "card": F.length(digits).between(12, 19) & F.call_function("luhn_check", digits),
        "phone": F.length(digits).between(9, 15)}[kind]


def _check(kind: Column, value: Column) -> Column:
    """Whether the value passes the check of its kind, whatever its marks."""
    plain = F.regexp_replace(value, "[^0-9.]", "")
    return F.when(kind == 1, _valid("ip", plain)).when(kind == 2, _valid("card", value)).when(kind == 3, _valid("phone", value)).otherwise(True)


def _span(kind: int, c: Column) -> Column:
    return F.struct(c["start"].alias("start"), F.lit(kind).alias("kind"), (c["start"] + F.length(c["value"])).alias("end"))


def features_of(kind: Column, value: Column, before: Column, after: Column) -> Column:
    """The features of one proposal, in the order of ``FEATURES``."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    groups = F.filter(F.split(value, "[^0-9]+"), lambda g: g != "")
    count = lambda pattern: F.length(value) - F.length(F.regexp_replace(value, pattern, ""))
    has = lambda text, pattern: text.rlike(pattern).cast("double")
    values = [
        kind, F.length(value), F.length(digits), F.size(groups), F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)),
        F.coalesce(F.length(F.get(groups, F.lit(0))), F.lit(0)), F.coalesce(F.length(F.element_at(F.concat(F.array(F.lit("")), groups), -1)), F.lit(0)),
        count("[^A-Za-z0-9]"), has(value, r"^\+"), has(value, r"\("), has(value, "@"), count(r"\."), count("-"), count("[A-Za-z]"),
        has(before, "[A-Za-z]$"), has(before, "[0-9]$"), has(before, r"[^A-Za-z0-9\s]$"), has(after, "^[A-Za-z]"), has(after, "^[0-9]"),
        has(after, r"^[^A-Za-z0-9\s.,;:!?]"), has(before, r"(?i)\b(?:tel|phone|call|mobile|fax|cell|ph)\b"), has(before, r"(?i)\b(?:e-?mail|contact|write|mailto)\b"),
        has(before, r"(?i)\b(?:ip|host|server|address|addr|ping)\b"), has(before, r"(?i)\b(?:card|visa|pay|payment|account|amex)\b"), has(before, r"(^|\n)\s*$"), _check(kind, value)]
    return F.array(*[v.cast("double") for v in values])


def _disguised(value: Column) -> Column:
    """The value without its telltale sign: a number without country code, an address with its marks spelt out."""
    number = F.regexp_replace(value, r"^\+[0-9]{1,3}[ .-]?(?=[(0-9])", "")
    spelt = F.regexp_replace(F.regexp_replace(value, "@", " [at] "), r"\.", " [dot] ")
    return F.when(F.contains(value, F.lit("@")), spelt).otherwise(number)


def _proposal(k: int, start: Column, value: Column, before: Column, after: Column, alone: Column) -> Column:
    return F.struct(
        start.alias("start"), F.lit(k).alias("kind"), (start + F.length(value)).alias("end"), features_of(F.lit(k), value, before, after).alias("f"),
        features_of(F.lit(k), _disguised(value), before, after).alias("plain"), F.xxhash64(value).alias("v"), alone.alias("alone"))


def _parts(name: str) -> Column:
    """The parts of the runs in array ``name`` that begin and end with a group of digits and have few enough of them: start,
    the sign before the first digit, value without it, digits, the text beside it, and whether the run goes on there.

    Each step is an array of its own, so that nothing is computed again for each part.
    """
    runs = F.transform(name, lambda c: F.struct(c["start"].alias("start"), c["before"].alias("before"), c["after"].alias("after"),
                                                F.regexp_extract_all(c["value"], F.lit("[^0-9]*[0-9]+"), F.lit(0)).alias("pieces")))
    runs = F.transform(runs, lambda c: c.withField("sizes", F.transform(c["pieces"], F.length)))
    runs = F.transform(runs, lambda c: c.withField("at", _offsets(c["sizes"])).withField(
        "digits", F.transform(c["pieces"], lambda p: F.length(F.regexp_extract(p, "[0-9]+$", 0)))))

    def of(c: Column) -> Column:
        def ends(i: Column) -> Column:
            window = F.slice(c["digits"], i + 1, MOST_DIGITS)
            sums = F.transform(window, lambda _, j: F.aggregate(F.slice(window, 1, j + 1), F.lit(0), lambda a, x: a + x))
            fits = F.filter(F.transform(sums, lambda n, j: F.struct(n.alias("digits"), (i + j).alias("last"))), lambda e: (e["digits"] >= 4) & (e["digits"] <= MOST_DIGITS))
            return F.transform(fits, lambda e: part(i, e["last"], e["digits"]))

        def part(i: Column, last: Column, digits: Column) -> Column:
            first, low = F.get(c["pieces"], i), F.greatest(i - 8, F.lit(0))
            lead = F.length(first) - F.get(c["digits"], i)
            sign = F.regexp_extract(F.left(first, lead), "[+(]$", 0)
            text = F.array_join(F.slice(c["pieces"], i + 1, last - i + 1), "")
            left = F.concat(F.when(low == 0, c["before"]).otherwise(""), F.array_join(F.slice(c["pieces"], low + 1, i - low), ""), F.left(first, lead - F.length(sign)))
            right = F.concat(F.array_join(F.slice(c["pieces"], last + 2, 24), ""), F.when(last + 25 >= F.size(c["pieces"]), c["after"]).otherwise(""))
            return F.struct(
                (c["start"] + F.get(c["at"], i) + lead).alias("start"), sign.alias("sign"), text.substr(lead + 1, F.length(text)).alias("value"), digits.alias("digits"),
                F.right(left, F.lit(24)).alias("before"), F.left(right, F.lit(24)).alias("after"), ((i > 0) | (last + 1 < F.size(c["pieces"]))).alias("part"))

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(c["pieces"]) - 1), ends))

    return F.flatten(F.transform(runs, of))


def _numbers(name: str) -> Column:
    """Proposals of ips, cards and phones from the parts in array ``name``; a phone has its sign with it."""
    def of(c: Column) -> Column:
        bare, signed = c["value"], F.concat(c["sign"], c["value"])
        alone = lambda k, v: c["part"] & v.rlike("^(?:" + BASE[KINDS[k]] + ")$") & _valid(KINDS[k], v)
        shape = bare.rlike(r"^[0-9]{1,3}(?: ?\[?\.\]? ?[0-9]{1,3}){3}$")
        before = F.right(F.concat(c["before"], c["sign"]), F.lit(24))
        return F.filter(F.array(
            F.when(shape, _proposal(1, c["start"], bare, before, c["after"], alone(1, bare))),
            F.when(c["digits"].between(12, 19), _proposal(2, c["start"], bare, before, c["after"], alone(2, bare))),
            F.when(c["digits"].between(7, 15), _proposal(3, (c["start"] - F.length(c["sign"])).cast("int"), signed, c["before"], c["after"], alone(3, signed)))),
            lambda p: p.isNotNull())
    return F.flatten(F.transform(name, of))


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _base_spans(number: int, kind: str) -> Column:
    return F.transform(F.filter(f"b_{kind}", lambda c: _valid(kind, c["value"])), lambda c: _span(number, c))


def candidates(documents: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` of ``documents`` with arrays ``base`` and ``wide``: valid base spans, and proposals with ``label``."""
    df = documents.select(*[F.col(c).alias(f"keep_{c}") for c in keep], F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    number = F.col("text").rlike("[0-9]")
    for kind in KINDS:
        hint = HINTS[kind]
        df = _matches(df, f"b_{kind}", BASE[kind], number if hint is None else F.contains("text", F.lit(hint)) & (number if kind != "email" else F.lit(True)))
    df = _matches(df, "w_email", WIDE_EMAIL, F.col("text").rlike(r"(?i)@|[\[(]at[\])]"))
    df = _matches(df, "w_number", WIDE_NUMBER, F.col("text").rlike(r"[0-9][ ()./\[\]-]{0,3}[0-9]"))
    spans = [_base_spans(k, kind) for k, kind in enumerate(KINDS)]
    emails = F.transform("w_email", lambda c: _proposal(0, c["start"], c["value"], c["before"], c["after"], F.lit(False)))
    df = df.withColumn("base", F.sort_array(F.concat(*spans))).withColumn("w_part", _parts("w_number"))
    df = df.withColumn("wide", F.concat(emails, _numbers("w_part")))

    def label(p: Column) -> Column:
        near = F.filter("base", lambda b: (b["kind"] == p["kind"]) & _overlaps(b, p))
        same, tail = F.exists(near, lambda b: (b["start"] == p["start"]) & (b["end"] == p["end"])), F.exists(near, lambda b: (b["start"] < p["start"]) & (b["end"] == p["end"]))
        return (F.when(p["kind"] == 0, (F.size(near) > 0).cast("int")).when(same, 1).when(tail | p["alone"] & (F.size(near) == 0), F.lit(None)).otherwise(0))

    wide = F.transform("wide", lambda p: p.withField("label", label(p)).dropFields("alone"))
    return df.select(*[F.col(f"keep_{c}").alias(c) for c in keep], "base", wide.alias("wide"))


def _hard_negatives(df: DataFrame, count: int = 240) -> DataFrame:
    """Numbers in common formats that are no personal data, as proposals of every kind; those that pass for base spans are left out."""
    n = df.sparkSession.range(count).withColumn("r", F.abs(F.xxhash64("id")))
    part = lambda low, size, at: (low + F.floor(F.col("r") / F.lit(10.0 ** at)) % size).cast("string")
    two = lambda size, at: F.lpad(part(1, size, at), 2, "0")
    many = lambda size, at: F.lpad(part(0, 10 ** size, at), size, "0")
    formats = [
        F.concat(part(1950, 100, 0), F.lit("-"), two(12, 2), F.lit("-"), two(28, 4)), F.concat(two(28, 0), F.lit("/"), two(12, 2), F.lit("/"), part(1950, 100, 4)),
        F.concat(part(1900, 100, 0), F.lit("-"), part(1900, 100, 3)), F.concat(F.lit("978-"), part(0, 9, 0), F.lit("-"), many(2, 1), F.lit("-"), many(6, 3), F.lit("-"), part(0, 9, 9)),
        F.concat(part(1, 20, 0), F.lit("."), part(0, 30, 2), F.lit("."), part(0, 30, 4), F.lit("."), part(300, 9000, 6)), many(8, 0), many(10, 1), many(13, 1), many(16, 0),
        F.concat(part(1, 900, 0), F.lit("."), many(3, 3), F.lit("."), many(3, 6)), F.concat(part(1, 90000, 0), F.lit("."), many(6, 5)),
        F.concat(part(1950, 100, 0), two(12, 2), two(28, 4), F.lit(" "), many(4, 6))]
    rows = n.select("id", F.explode(F.array(*formats)).alias("v"), F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("k"))
    rows = rows.filter(~((F.col("k") < 3) & _check(F.col("k"), F.col("v"))))
    return rows.select(features_of(F.col("k"), F.col("v"), F.lit("of "), F.lit(" ")).alias("f"), F.lit(0).alias("label"), (F.pmod(F.xxhash64("v"), F.lit(3)) == 0).alias("apart"))


def _tree(node, f: Column) -> Column:
    if not node.getClass().getSimpleName().startswith("Internal"):
        return F.lit(float(node.prediction()))
    split = node.split()
    return F.when(F.get(f, F.lit(split.featureIndex())) <= split.threshold(), _tree(node.leftChild(), f)).otherwise(_tree(node.rightChild(), f))


class SpanModel:
    """Boosted trees and a threshold per kind; no tree at all if there was nothing to learn from."""

    def __init__(self, trees: list, weights: list[float], thresholds: dict[int, float]) -> None:
        self.trees, self.weights, self.thresholds = trees, weights, thresholds

    def score(self, f: Column) -> Column:
        total = reduce(lambda a, b: a + b, [_tree(t, f) * w for t, w in zip(self.trees, self.weights, strict=True)], F.lit(0.0))
        return 1 / (1 + F.exp(-2 * total))


def _weighted(found: DataFrame, sample: int) -> DataFrame:
    """``(f, label, apart, weight, shown)``: every distinct vector; ``shown`` is the number of values that have it, ``weight`` the same within the kind's bound."""
    each = found.filter(F.size("wide") > 0).select(F.explode("wide").alias("p")).select("p.f", "p.plain", "p.label", "p.v").filter("label is not null")
    each = each.withColumn("apart", F.pmod("v", F.lit(3)) == 0)
    groups = each.groupBy("f", "plain", "label", "apart").agg(F.count_distinct("v").alias("n"))
    groups = stored(groups.withColumn("kind", F.get("f", F.lit(0)).cast("int")), "vectors")
    total = {r["kind"]: r["n"] for r in groups.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    scale = F.coalesce(*[F.when(F.col("kind") == k, min(1.0, sample / len(KINDS) / n)) for k, n in sorted(total.items())], F.lit(1.0))
    both = groups.select(F.explode(F.when(F.col("label") == 1, F.array("f", "plain")).otherwise(F.array("f"))).alias("f"), "label", "apart", "kind", "n")
    merged = both.groupBy("f", "label", "apart", "kind").agg(F.sum("n").cast("double").alias("shown"))
    return merged.select("f", "label", "apart", (F.col("shown") * scale).alias("weight"), "shown")


def fit_spans(found: DataFrame, sample: int = 20_000, rounds: int = 12, depth: int = 4, precision: float = 0.99, least: int = 30, seed: int = 7) -> SpanModel:
    """Fit on all proposals of ``found`` and choose the thresholds on all of the part set apart."""
    rows = stored(_weighted(found, sample).unionByName(_hard_negatives(found).withColumns({"weight": F.lit(1.0), "shown": F.lit(0.0)})), "spans")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.sum(F.greatest("weight", "shown")).alias("n")).collect()}
    if min(counts.get(0, 0), counts.get(1, 0)) < least:
        return SpanModel([], [], {})
    table = rows.select(*[F.get("f", F.lit(i)).alias(n) for i, n in enumerate(FEATURES)], F.col("label").cast("double").alias("label"), "apart", "weight")
    table = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(table)
    fitted = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=seed).fit(table.filter("not apart"))
    model = SpanModel([t._call_java("rootNode") for t in fitted.trees], list(fitted.treeWeights), {})
    held = rows.filter("apart").select(
        F.get("f", F.lit(0)).cast("int").alias("kind"), F.round(model.score(F.col("f")), 3).alias("score"), "label", "weight", "shown")
    of = lambda c: F.sum(F.col("label") * F.col(c))
    sums = held.groupBy("kind", "score").agg(of("weight").alias("good"), of("shown").alias("shown"), F.sum("weight").alias("n"))
    steps: dict[int, list[tuple[float, float, float, float]]] = {}
    for r in sums.orderBy(F.desc("score")).collect():
        steps.setdefault(r["kind"], []).append((r["score"], r["good"], r["shown"], r["n"]))
    for kind, ordered in steps.items():
        good = seen = total = 0.0
        for score, g, shown, n in ordered:
            good, seen, total = good + g, seen + shown, total + n
            if seen >= least and good >= precision * total:
                model.thresholds[kind] = score
    return model


def with_added(found: DataFrame, model: SpanModel) -> DataFrame:
    """``found`` with ``spans``, the base spans and those that the model adds, in place of the proposals."""
    if not model.thresholds:
        return found.withColumn("spans", F.col("base")).drop("wide")
    limit = F.create_map(*[F.lit(x) for k, t in model.thresholds.items() for x in (k, t - 0.0005)])
    scored = F.transform("wide", lambda p: F.struct(p["start"].alias("start"), p["kind"].alias("kind"), p["end"].alias("end"), model.score(p["f"]).alias("score")))
    found = found.withColumn("wide", F.when(F.size("wide") > 0, scored))
    clear = F.filter("wide", lambda p: (p["score"] >= F.element_at(limit, p["kind"])) & ~F.exists("base", lambda b: _overlaps(b, p)))
    found = found.withColumn("wide", clear)
    ordered = F.sort_array(F.transform("wide", lambda p: F.struct((-p["score"]).alias("loss"), p["start"].alias("start"), (-p["end"]).alias("minus_end"), p["kind"].alias("kind"))))
    spans = F.transform(ordered, lambda p: F.struct(p["start"].alias("start"), p["kind"].alias("kind"), (-p["minus_end"]).alias("end")))
    none = F.array().cast("array<struct<start: int, kind: int, end: int>>")
    added = F.aggregate(spans, none, lambda acc, p: F.when(F.exists(acc, lambda q: _overlaps(q, p)), acc).otherwise(F.concat(acc, F.array(p))))
    return found.withColumn("spans", F.when(F.size("wide") > 0, F.sort_array(F.concat("base", added))).otherwise(F.col("base"))).drop("wide")


def find_personal(documents: DataFrame, keep: list[str], text_col: str = "text", sample: int = 20_000) -> DataFrame:
    """Columns ``keep`` with ``base`` and ``spans``: arrays of (start, kind, end), positions in code points, ``kind`` an index of ``KINDS``."""
    found = stored(candidates(documents, keep, text_col), "personal")
    return with_added(found, fit_spans(found, sample))


def joined(spans: str) -> Column:
    """``kind:start:end`` of an array of spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def redacted(text: str, spans: str) -> Column:
    """The text with each span, or run of overlapping spans, replaced by the first one's kind in brackets."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    body = F.col(text)
    zero = F.struct(F.lit(1).alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate(
        spans, zero, lambda acc, s: F.when(s["start"] >= acc["at"] - 1, F.struct(
            (s["end"] + 1).alias("at"), F.concat(acc["out"], F.array(body.substr(acc["at"], s["start"] - acc["at"] + 1), F.get(names, s["kind"]))).alias("out")))
        .otherwise(F.struct(F.greatest(acc["at"], s["end"] + 1).alias("at"), acc["out"].alias("out"))),
        lambda acc: F.concat(F.array_join(acc["out"], ""), body.substr(acc["at"], F.length(body))))
    return F.when(F.size(spans) > 0, done).otherwise(body)
