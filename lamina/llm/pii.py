"""Personal data by candidate spans and boosted trees, in DataFrame operations alone.

Generators with high recall propose spans, which may overlap: regular
expressions for e-mail addresses, network addresses, card and phone numbers,
secrets, and national phone and insurance numbers. Each candidate has features
of its format and of the text around it. Boosted trees, trained on the candidates
of all documents, whose weak labels come from checks of format and context,
give it a score, and each kind has the least threshold that keeps its
precision on the third of the documents that is held out. Spans of the four base kinds that
pass their checks always count; a candidate of another kind counts if its
score reaches the threshold and no span that counts overlaps it.

The trees become one SQL expression, so that scoring a text is part of the scan
that reads it: nothing is exploded, shuffled or gathered by document.

A null text is empty and has no spans. Spans are counted in code points, the
end exclusive. Repeated rows give repeated results; an empty table none, and
candidates without both labels give no model, so only base spans count.
"""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import frames

TREES, DEPTH = 12, 3
PRECISION = 0.98
BEFORE, AFTER = 24, 8  # characters of context
BLOCK = 128  # matches whose spans are put together at once; more than BEFORE / 2

KINDS = ("email", "ip", "card", "phone", "secret", "national", "insurance")
BASE_KINDS = 4

# The patterns of the base kinds. They find what the plain forms
# find, leftmost first. A run is only tried from its beginning or from the end
# of the last match, and repeated groups give nothing back, so that a text
# that is one long run takes no more than its length.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{16,}+",
    "national": r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "insurance": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
# What a text must hold for a pattern to be tried.
_GATES = {"email": "contains(text, '@')", "phone": "contains(text, '+')"}

_CONTEXT_SECRET = "(token|secret|key|passw|pwd|auth|bearer|credential)[a-z_]*[^a-z0-9]{0,5}$"
_CONTEXT_PHONE = "(tel|phone|call|mobile|cell|fax|contact)[a-z]*[^a-z0-9]{0,5}$"
_CONTEXT_PERSON = "(ssn|social|security|insurance)[a-z ]*[^a-z0-9]{0,5}$"

# Matches that no check could pass are not kept: a text may be all numbers, and
# keeping a span copies those before it.
_PLAUSIBLE = {
    "card": "length({m}) BETWEEN 12 AND 37",
    "phone": "length({m}) >= 10",
    "secret": "{m} RLIKE '[0-9]' AND {m} RLIKE '[A-Za-z]'",
}

_EMPTY = (
    "CAST(array() AS array<struct<kind: int, start: int, stop: int, value: string, before: string, after: string>>)"
)


def _candidates_of(kind: str) -> str:
    """Spans of one generator as an array, from its matches ``m`` and the text between them ``s``.

    The context is that of the text, other matches included. It is put together
    from the pieces, since fetching it by position would read the text up to there.
    An array that grows is copied with each step, so matches are taken in blocks:
    the places where blocks begin first, then the spans of each block from there.
    """
    k = KINDS.index(kind)
    m, s = f"m_{kind}", f"s_{kind}"
    begin = f"a.at + length({s}[i])"
    # A match has two characters at least, so these pieces hold what is behind or before one.
    ahead = ", ".join(
        f"left(coalesce(get({x}, i + {j}), ''), {AFTER})" for j in range(1, AFTER // 2 + 1) for x in (s, m)
    )
    behind = (
        f"IF(b = 0, '', right(array_join(transform(sequence(b * {BLOCK} - {BEFORE // 2}, b * {BLOCK} - 1), "
        f"j -> concat(right({s}[j], {BEFORE}), right({m}[j], {BEFORE}))), ''), {BEFORE}))"
    )
    span = (
        f"named_struct('kind', {k}, 'start', {begin}, 'stop', {begin} + length({m}[i]), 'value', {m}[i], "
        f"'before', lower(right(concat(a.last, {s}[i]), {BEFORE})), 'after', left(concat({ahead}), {AFTER}))"
    )
    last = f"right(concat(a.last, right({s}[i], {BEFORE}), right({m}[i], {BEFORE})), {BEFORE})"
    kept = _PLAUSIBLE.get(kind, "true").format(m=f"{m}[i]")
    block = f"sequence(b * {BLOCK}, least(b * {BLOCK} + {BLOCK - 1}, size({m}) - 1))"
    begins = (
        f"aggregate(sequence(0, (size({m}) - 1) div {BLOCK}), "
        "named_struct('at', 0, 'out', CAST(array() AS array<int>)), "
        f"(a, b) -> named_struct('at', aggregate({block}, a.at, (t, i) -> t + length({s}[i]) + length({m}[i])), "
        "'out', concat(a.out, array(a.at))), a -> a.out)"
    )
    spans = (
        f"aggregate({block}, named_struct('at', at, 'last', {behind}, 'out', {_EMPTY}), "
        f"(a, i) -> named_struct('at', {begin} + length({m}[i]), 'last', {last}, 'out', "
        f"IF({kept}, concat(a.out, array({span})), a.out)), a -> a.out)"
    )
    return f"IF(size({m}) = 0, {_EMPTY}, flatten(transform({begins}, (at, b) -> {spans})))"


# Features of a candidate ``c``, in this order; digits are those of its value.
_DIGITS = "regexp_replace(c.value, '[^0-9]', '')"
FEATURES = {
    "kind": "c.kind",
    "length": "length(c.value)",
    "digits": "length(c.digits)",
    "letters": "length(regexp_replace(c.value, '[^A-Za-z]', ''))",
    "capitals": "length(regexp_replace(c.value, '[^A-Z]', ''))",
    "hex_only": "IF(c.value RLIKE '^[0-9A-Fa-f]+$', 1, 0)",
    "distinct": "size(array_distinct(split(c.value, '')))",
    "checksum": "IF(c.luhn, 1, 0)",
    "octets": "IF(c.octets, 1, 0)",
    "after_secret": f"IF(c.before RLIKE '{_CONTEXT_SECRET}', 1, 0)",
    "after_phone": f"IF(c.before RLIKE '{_CONTEXT_PHONE}', 1, 0)",
    "after_person": f"IF(c.before RLIKE '{_CONTEXT_PERSON}', 1, 0)",
    "after_space": "IF(c.before = '' OR c.before RLIKE '\\\\s$', 1, 0)",
    "before_space": "IF(c.after = '' OR c.after RLIKE '^\\\\s', 1, 0)",
    "quoted": "IF(c.before RLIKE '[\"\\']$' AND c.after RLIKE '^[\"\\']', 1, 0)",
    "last_part": "length(regexp_extract(c.value, '([A-Za-z]*)$', 1))",
}

_LUHN = (
    "length(c.digits) BETWEEN 12 AND 19 AND aggregate(sequence(1, least(length(c.digits), 19)), 0, (t, j) -> t + "
    "CASE WHEN j % 2 = 1 THEN int(substring(c.digits, -j, 1)) "
    "WHEN int(substring(c.digits, -j, 1)) > 4 THEN 2 * int(substring(c.digits, -j, 1)) - 9 "
    "ELSE 2 * int(substring(c.digits, -j, 1)) END) % 10 = 0"
)
_OCTETS = r"c.value RLIKE '^(0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\\.|$)){4}$'"

# Whether a base candidate passes its kind's checks; other kinds have none.
_VALID = (
    "CASE c.kind WHEN 0 THEN true WHEN 1 THEN c.octets WHEN 2 THEN c.luhn "
    "WHEN 3 THEN length(c.digits) BETWEEN 9 AND 15 ELSE false END"
)
# Weak labels: what a check of format, or of the words before, says.
_WEAK = (
    "CASE c.kind WHEN 0 THEN c.value RLIKE '[.][A-Za-z]{2,}$' "
    f"WHEN 4 THEN c.before RLIKE '{_CONTEXT_SECRET}' AND length(c.digits) >= 3 "
    f"WHEN 5 THEN c.before RLIKE '{_CONTEXT_PHONE}' "
    f"WHEN 6 THEN c.before RLIKE '{_CONTEXT_PERSON}' "
    "ELSE c.valid END"
)


def _proposed(docs: DataFrame, text_col: str) -> DataFrame:
    """``row`` (all columns), ``text``, and ``found``: what the generators propose and the checks say."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    made = docs.select(frames.as_row(docs), text)
    none = F.array().cast("array<string>")
    for kind, pattern in PATTERNS.items():
        gate = F.expr(_GATES.get(kind, "true"))
        matches = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        made = made.withColumn(f"m_{kind}", F.when(gate, matches).otherwise(none))
    for kind, pattern in PATTERNS.items():
        some = F.size(f"m_{kind}") > 0
        made = made.withColumn(f"s_{kind}", F.when(some, F.split("text", pattern, -1)).otherwise(none))
    spans = made.select("row", "text", F.expr(f"concat({', '.join(map(_candidates_of, PATTERNS))})").alias("found"))
    steps = [
        f"transform(found, c -> struct({_copied()}, {_DIGITS} AS digits))",
        f"transform(found, c -> struct({_copied('digits')}, {_LUHN} AS luhn, {_OCTETS} AS octets))",
        f"transform(found, c -> struct({_copied('digits', 'luhn', 'octets')}, {_VALID} AS valid))",
    ]
    for step in steps:
        spans = spans.withColumn("found", F.expr(step))
    return spans


def _copied(*more: str) -> str:
    names = ["kind", "start", "stop", "value", "before", "after", *more]
    return ", ".join(f"c.{n} AS {n}" for n in names)


def candidates(docs: DataFrame, text_col: str = "text", out: str = "candidates") -> DataFrame:
    """All columns and ``out``: every proposed span with its context and what its checks say."""
    columns = frames.from_row(docs.columns, {})
    return _proposed(docs, text_col).select(*columns, F.col("found").alias(out))


def _tree_sql(text: str) -> str:
    """A tree's printed form as a CASE expression over ``c.f``."""
    rows = [line.strip() for line in text.splitlines() if re.match(r"\s*(If|Else|Predict)", line)]

    def build(at: int) -> tuple[str, int]:
        if rows[at].startswith("Predict"):
            return f"{float(rows[at].split(':')[1])!r}D", at + 1
        feature, bound = re.search(r"feature (\d+) <= ([-0-9.E]+)", rows[at]).groups()
        low, at = build(at + 1)
        high, at = build(at + 1)
        return f"IF(c.f[{feature}] <= {float(bound)!r}D, {low}, {high})", at

    return build(0)[0]


class Model:
    """Score of a candidate as SQL over its features, and the threshold of each kind."""

    def __init__(self, score: str, thresholds: dict[str, float]) -> None:
        self.score, self.thresholds = score, thresholds

    def accepted(self) -> str:
        cases = "".join(
            f" WHEN {KINDS.index(k)} THEN c.p >= {t!r}D" for k, t in self.thresholds.items() if KINDS.index(k) >= BASE_KINDS
        )
        return f"CASE c.kind{cases} ELSE false END" if cases else "false"


def _features(column: str = "c") -> str:
    return f"array({', '.join(f'double({e})' for e in FEATURES.values())})"


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Trees and thresholds from the candidates of all documents.

    A third of the documents, by the hash of the id, is held out for the
    thresholds. Candidates with the same features and label are one row with
    their number as its weight, so what the trees are grown on is far smaller
    than the candidates, and nothing of it is left out.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    weak = (
        candidates(texts)
        # explode() would add a filter on the array's size that proposes all spans again.
        .select("id", F.explode_outer("candidates").alias("c"))
        .where("c IS NOT NULL")
        .selectExpr("id", "c.kind AS kind", f"{_features()} AS f", f"int({_WEAK}) AS label")
        .withColumn("held", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(3)) == 0)
        .where("label IS NOT NULL")
    )
    counted = weak.groupBy("held", "kind", "label", "f").agg(F.count("*").alias("weight"))
    named = [F.col("f")[i].alias(f"x_{name}") for i, name in enumerate(FEATURES)]
    table = frames.written(counted.select("label", "held", "kind", F.col("weight").cast("double"), *named), "candidates")
    fit = table.where("NOT held")
    known = fit.groupBy("label").count().collect()  # a row a label
    if len(known) < 2:
        return Model("0D", {})
    assembler = VectorAssembler(inputCols=[f"x_{k}" for k in FEATURES], outputCol="features")
    # Splits are looked for in all rows, not in a part of them, where the square of the bins is as large.
    bins = max(32, math.isqrt(sum(r["count"] for r in known)) + 1)
    trees = GBTClassifier(
        maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=0, maxBins=bins, labelCol="label", weightCol="weight"
    ).fit(assembler.transform(fit))
    margin = " + ".join(f"{w!r}D * {_tree_sql(t.toDebugString)}" for t, w in zip(trees.trees, trees.treeWeights))
    score = f"1D / (1D + exp(-2D * ({margin})))"
    held = table.where("held").selectExpr(
        "kind", "label", "weight", f"struct(array({', '.join(f'x_{k}' for k in FEATURES)}) AS f) AS c"
    )
    # Twenty steps of the score for each kind: the least from which on the precision holds.
    steps = held.selectExpr("kind", "label", "weight", f"int(floor(least(0.999D, {score}) * 20)) AS step")
    counts = steps.groupBy("kind", "step").agg(
        F.sum(F.col("label") * F.col("weight")).alias("hits"), F.sum("weight").alias("n")
    ).collect()
    thresholds = {}
    for k, kind in enumerate(KINDS):
        hits = total = 0
        for row in sorted((r for r in counts if r["kind"] == k), key=lambda r: -r["step"]):
            hits, total = hits + row["hits"], total + row["n"]
            if hits >= PRECISION * total:
                thresholds[kind] = row["step"] / 20
    return Model(score, thresholds)


def _counted(docs: DataFrame, model: Model, text_col: str) -> DataFrame:
    """``row``, ``text`` and ``spans``, what counts, by start and kind."""
    format_of = "c.kind AS kind, c.start AS start, c.stop AS stop, c.valid AS valid"
    better = (
        "CASE WHEN x.p > y.p THEN -1 WHEN x.p < y.p THEN 1 WHEN x.start < y.start THEN -1 "
        "WHEN x.start > y.start THEN 1 ELSE x.kind - y.kind END"
    )
    overlap = "b.start < c.stop AND c.start < b.stop"
    names = ", ".join(f"'{k}'" for k in KINDS)
    found = _proposed(docs, text_col)
    def cut(spans: str) -> str:
        """Length of the pieces that make a search through spans cost the root of their number."""
        return f"greatest(1, int(sqrt(size({spans}))))"

    def stops(piece: str) -> str:
        return f"coalesce(array_max(transform({piece}, c -> c.stop)), 0)"

    none = "CAST(array() AS array<int>)"
    by_start = "(x, y) -> CASE WHEN x.start < y.start THEN -1 WHEN x.start > y.start THEN 1 ELSE 0 END"
    piece = f"slice(sorted, int(b * {cut('sorted')}) + 1, {cut('sorted')})"
    some = f"slice(ordered, int(b * {cut('ordered')}) + 1, {cut('ordered')})"
    begun = f"slice(ordered, int(i div {cut('ordered')}) * {cut('ordered')} + 1, i % {cut('ordered')})"
    # What stands once within a lambda may be computed there anew, so sizes are asked for as well.
    steps = {
        # Base kinds need no score: their checks decide.
        "featured": f"transform(found, c -> struct({format_of}, "
        f"IF(c.kind < {BASE_KINDS}, CAST(array() AS array<double>), {_features()}) AS f))",
        "scored": f"transform(featured, c -> struct({format_of}, IF(c.kind < {BASE_KINDS}, 0D, {model.score}) AS p))",
        "base": "filter(scored, c -> c.valid)",
        # A candidate is only compared with those pieces of the base spans that it reaches into.
        "sorted": "array_sort(transform(base, c -> struct(c.start AS start, c.stop AS stop)))",
        "pieces": f"transform(filter(sequence(0, size(sorted) div {cut('sorted')}), "
        f"b -> b * {cut('sorted')} < size(sorted)), b -> struct({piece} AS spans, "
        f"sorted[int(b * {cut('sorted')})].start AS start, {stops(piece)} AS stop))",
        "ordered": f"array_sort(filter(scored, c -> {model.accepted()} AND (size(pieces) = 0 OR NOT exists(pieces, "
        f"b -> {overlap} AND exists(b.spans, b -> {overlap})))), {by_start})",
        # Of overlapping further spans the one of the best score counts. Runs of spans that
        # overlap are told apart by the furthest stop so far, and decided one by one.
        "reach": f"aggregate(sequence(0, size(ordered) div {cut('ordered')}), named_struct('top', 0, 'out', {none}), "
        f"(a, b) -> named_struct('top', greatest(a.top, {stops(some)}), 'out', concat(a.out, array(a.top))), a -> a.out)",
        "heads": f"IF(size(ordered) = 0 OR size(reach) = 0, {none}, filter(sequence(0, greatest(size(ordered) - 1, 0)), "
        f"i -> ordered[i].start >= greatest(reach[int(i div {cut('ordered')})], {stops(begun)})))",
        "kept": "flatten(transform(heads, (h, j) -> aggregate(array_sort(slice(ordered, h + 1, "
        f"coalesce(get(heads, j + 1), size(ordered)) - h), (x, y) -> {better}), slice(ordered, 1, 0), "
        f"(a, c) -> IF(exists(a, b -> {overlap}), a, concat(a, array(c))))))",
        "spans": "array_sort(transform(concat(base, kept), c -> struct(c.start AS start, c.kind AS kind, "
        f"c.stop AS stop, c.valid AS base, array({names})[c.kind] AS name)))",
    }
    for name, step in steps.items():
        found = found.withColumn(name, F.expr(step))
    return found.select("row", "text", "spans")


def spans(docs: DataFrame, model: Model, text_col: str = "text", out: str = "spans") -> DataFrame:
    """All columns and ``out``: the spans that count, by start and kind.

    Each has ``start``, ``kind`` (its number), ``stop``, ``base`` and ``name``.
    """
    columns = frames.from_row(docs.columns, {})
    return _counted(docs, model, text_col).select(*columns, F.col("spans").alias(out))


def _listed(condition: str) -> Column:
    return F.expr(
        f"array_join(transform(filter(spans, c -> {condition}), c -> concat_ws(':', c.name, c.start, c.stop)), ',')"
    )


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents with each span replaced by its kind in brackets; all columns stay.

    Overlapping spans are replaced together, by the name of the first.
    ``n_chars``, where there is one, follows a changed text; a null text stays.
    """
    found = _counted(docs, model or train(docs), "text")
    text = (
        "aggregate(spans, named_struct('at', 0, 'out', ''), (a, c) -> IF(c.start < a.at, "
        "named_struct('at', greatest(a.at, c.stop), 'out', a.out), named_struct('at', c.stop, 'out', "
        "concat(a.out, substring(text, a.at + 1, c.start - a.at), '[', upper(c.name), ']'))), "
        "a -> concat(a.out, substring(text, a.at + 1)))"
    )
    some = F.size("spans") > 0
    found = found.withColumn("text", F.when(some, F.expr(text)).otherwise(F.col("row")["text"]))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(some, chars).otherwise(F.col("row")["n_chars"])
    return found.select(frames.from_row(docs.columns, changed))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of personal data in every document."""
    docs = frames.documents(spark, sf_dir).select("doc_id", "text")
    found = spans(docs, train(docs))
    counts = [
        F.expr(f"CAST(size(filter(spans, c -> c.kind = {k})) AS BIGINT)").alias(f"n_{KINDS[k]}")
        for k in range(BASE_KINDS)
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_listed("c.base").cast("binary"), 256).alias("base_sha256"),
        _listed("true").alias("spans"),
    )
