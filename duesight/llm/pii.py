"""Personal data: generators propose spans, boosted trees judge them, calibrated thresholds select redactions.

Generators are patterns with high recall for e-mail and IP addresses, card and phone numbers; their spans
may overlap across kinds. Four of them propose what a strict rule decides (address parts at most 255,
12 to 19 digits with a right check digit, 9 to 15 digits after a plus): spans that satisfy it are *base* spans and
always stay, spans that fail it never do. The others propose *loose* spans, for which there is no rule: spelled-out
mail signs, phone numbers without a plus.

Gradient-boosted trees learn base against failed spans, and judge the loose ones. They
see the words, signs and digits around a span and how it is set off from them, but nothing that the rules look at (digits,
check digit, address parts, plus sign, signs between), so they learn where personal data stands and not the rule over again. Every base and every failed span takes part:
two of three, by a hash, teach the trees, the others calibrate one threshold for each kind, the lowest score from which on
base spans reach the wanted precision. Spans that look the same to the trees are one row with their number as its weight. Loose spans at or above it are selected, unless they overlap a base span.

DataFrame operations only. Positions are code points, ends exclusive. Null texts count as empty and have no spans.
Rows that repeat give their spans each. Without enough examples of both classes no loose span is selected. Texts of any
length are read whole, empty tables give no rows, and columns other than id and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duesight.llm.scratch import cut, free

KINDS = ("email", "ip", "card", "phone")
# A run of name characters is tried from its start, or where the last match ended: each character is passed once.
_NAME = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++"
#: kind, whether its spans can be base spans, pattern, and a cheap test whether a text can match.
GENERATORS = (
    ("email", True, _NAME + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"@"),
    ("ip", True, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    ("card", True, r"[0-9](?:[\x20-]?[0-9])++", r"(?:[0-9][\x20-]?){12}"),
    ("phone", True, r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
    ("email", False, _NAME + r"\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:(?:\x20?[\[(]dot[\])]\x20?|\.)[A-Za-z0-9-]++)++", r"[\[(]at[\])]"),
    ("phone", False, r"(?<![0-9+.-])(?:\([0-9]{3}\)|[0-9]{3})[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])", r"[0-9]{3}[\x20.-][0-9]{4}"),
)
#: Code points of context kept on either side of a span.
CONTEXT = 24
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


@dataclass(frozen=True)
class FitBounds:
    """How the trees are fitted and calibrated."""

    least: int = 20  # spans of each class, else nothing is learned
    precision: float = 0.99
    rounds: int = 12
    depth: int = 3


def _by_generator(gen: Column, make) -> Column:
    chosen = F.when(gen == 0, make(GENERATORS[0][2]))
    for i, (_, _, pattern, _) in enumerate(GENERATORS[1:], 1):
        chosen = chosen.when(gen == i, make(pattern))
    return chosen


def _strict(kind: Column, found: Column) -> Column:
    """The rule a span of a kind must satisfy to be a base span."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    n = F.length(digits)
    back = F.reverse(F.when(n.between(12, 19), digits).otherwise(F.lit("0")))
    doubled = F.transform(
        F.sequence(F.lit(1), F.length(back)),
        lambda i: F.substring(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1),
    )
    total = F.aggregate(doubled, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x))
    return (
        F.when(kind == "ip", found.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"))
        .when(kind == "card", n.between(12, 19) & (total % 10 == 0))
        .when(kind == "phone", n.between(9, 15))
        .otherwise(True)
    )


def proposals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, doc_id, text_hash, kind, start, end, base, ruled, found, before, after`` of every proposal, and one row at
    least for every document (kind null if it has none). ``ruled``: a rule decides it.

    A text is cut into gaps and matches; a start is the running sum of their lengths over narrow rows, which are
    dealt by document.
    """
    given = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    rows = given.select("row", "doc_id", "text", F.xxhash64("text").alias("text_hash"), F.explode_outer(_able(F.col("text"))).alias("gen"))
    gen = F.col("gen")
    pieces = rows.select(
        "row", "doc_id", "text_hash", "gen",
        _by_generator(gen, lambda p: F.regexp_extract_all("text", F.lit(p), F.lit(0))).alias("found"),
        _by_generator(gen, lambda p: F.split("text", p, -1)).alias("gap"),
    )
    # A text has one gap more than matches; the gap behind the last match is no proposal.
    zipped = F.arrays_zip("found", F.slice("gap", 1, F.size("found")).alias("gap"), F.slice("gap", 2, F.greatest(F.size("found"), F.lit(0))).alias("next"))
    zipped = F.when(F.size("found") > 0, zipped)
    each = pieces.select("row", "doc_id", "text_hash", "gen", F.posexplode_outer(zipped).alias("pos", "one"))
    kind = F.element_at(F.array(*[F.lit(x[0]) for x in GENERATORS]), F.col("gen") + 1)
    narrow = each.select(
        "row", "doc_id", "text_hash", "gen", "pos", kind.alias("kind"),
        F.col("one.found").alias("found"),
        F.length("one.found").cast("long").alias("size"),
        F.length("one.gap").cast("long").alias("skip"),
        F.right("one.gap", F.lit(CONTEXT)).alias("before"),
        F.left("one.next", F.lit(CONTEXT)).alias("after"),
    )
    end = F.sum(F.col("skip") + F.col("size")).over(Window.partitionBy("row", "gen").orderBy("pos"))
    placed = narrow.repartition("row").withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    # Short numbers are no cards by any reading. Their documents keep a row.
    held = F.col("found").isNotNull() & ((F.col("kind") != "card") | (F.length(F.regexp_replace("found", "[^0-9]", "")) >= 12))
    ruled = F.element_at(F.array(*[F.lit(x[1]) for x in GENERATORS]), F.col("gen") + 1)
    strict = ruled & _strict(F.col("kind"), F.col("found"))
    out = placed.filter(held | F.coalesce(F.col("pos") == 0, F.lit(True))).withColumn("held", held)
    return out.select(
        "row", "doc_id", "text_hash",
        *[F.when(F.col("held"), F.col(c)).alias(c) for c in ("kind", "start", "end", "found", "before", "after")],
        F.when(F.col("held"), strict).alias("base"),
        F.when(F.col("held"), ruled).alias("ruled"),
    )


def _able(text: Column) -> Column:
    """Numbers of the generators that can match a text."""
    tests = F.array(*[F.when(text.rlike(test), F.lit(i)) for i, (*_, test) in enumerate(GENERATORS)])
    return F.filter(tests, lambda x: x.isNotNull())


#: Classes of the word before a span, by hash: what stands before personal data is learned in any language.
WORD_CLASSES = 24


def features(spans: DataFrame) -> DataFrame:
    """Context of each span and how it is set off from it as numbers, in the columns ``x_*``; nothing that a rule looks at."""
    count = lambda c, pattern: F.length(c) - F.length(F.regexp_replace(c, pattern, ""))
    before, after = F.col("before"), F.col("after")
    flag = lambda test: test.cast("int")
    columns = {
        "joined_left": flag(before.rlike(r"[\p{L}0-9_]$")),
        "joined_right": flag(after.rlike(r"^[\p{L}0-9_]")),
        "quoted": flag(before.rlike(r"[\"'=:/]\x20?\S*$")),
        "digits_left": count(before, "[0-9]"),
        "digits_right": count(after, "[0-9]"),
        "named": flag(F.lower(before).rlike(r"mail|phone|tel|call|fax|card|visa|ip\b|addr|contact")),
    }
    kinds = {f"is_{kind}": flag(F.col("kind") == kind) for kind in KINDS}
    # The last whole word; a word cut off by the edge of the context counts by what is left of it.
    word = F.regexp_extract(F.lower(before), r"(\p{L}+)[^\p{L}]*$", 1)
    word_class = F.when(word != "", F.pmod(F.xxhash64(word), F.lit(WORD_CLASSES)))
    words = {f"word_{n}": flag(word_class == n) for n in range(WORD_CLASSES)}
    return spans.select("*", *[F.coalesce(c.cast("double"), F.lit(0.0)).alias(f"x_{name}") for name, c in (columns | kinds | words).items()])


def _assembled(rows: DataFrame) -> DataFrame:
    """Rows of ``features`` with the vector ``x``."""
    return VectorAssembler(inputCols=[c for c in rows.columns if c.startswith("x_")], outputCol="x").transform(rows)


@dataclass(frozen=True)
class Judge:
    trees: GBTClassificationModel
    thresholds: dict[str, float]

    def scored(self, spans: DataFrame) -> DataFrame:
        """The spans with ``score``, the trees' probability of a base span."""
        return self.judged(features(spans)).select(*spans.columns, "score")

    def judged(self, rows: DataFrame) -> DataFrame:
        """Rows of ``features`` with ``score``."""
        return self.trees.transform(_assembled(rows)).withColumn("score", vector_to_array("probability")[1])


def fit(spans: DataFrame, bounds: FitBounds = FitBounds()) -> Judge | None:
    """Fit and calibrate on all spans that a rule decides; None if they lack one of the classes."""
    part = F.pmod(F.xxhash64(F.lit("part"), "found"), F.lit(3)).alias("part")
    known = features(spans.filter("ruled")).withColumn("label", F.col("base").cast("double"))
    looks = [c for c in known.columns if c.startswith("x_")]
    alike = known.groupBy("kind", *looks, "label", part).agg(F.count(F.lit(1)).cast("double").alias("n"))
    examples = cut(alike, "pii-examples")
    numbers = {(r.label, r.learns): r.n for r in examples.groupBy("label", (F.col("part") < 2).alias("learns")).agg(F.sum("n").alias("n")).collect()}
    if min(sum(n for (label, _), n in numbers.items() if label == own) for own in (0.0, 1.0)) < bounds.least:
        return None
    if not {(0.0, True), (1.0, True)} <= set(numbers):
        return None
    learn = _assembled(examples.filter("part < 2")).select("x", "label", "n")
    trees = GBTClassifier(featuresCol="x", labelCol="label", weightCol="n", maxIter=bounds.rounds, maxDepth=bounds.depth, seed=1).fit(learn)
    # At most 101 steps of score for each kind reach the driver.
    steps = (
        Judge(trees, {}).judged(examples.filter("part = 2")).groupBy("kind", F.floor(F.col("score") * 100).alias("step"))
        .agg(F.sum("n").alias("n"), F.sum(F.col("label") * F.col("n")).alias("right")).collect()
    )
    thresholds = {}
    for kind in KINDS:
        n = right = 0
        for r in sorted((r for r in steps if r.kind == kind), key=lambda r: -r.step):
            n, right = n + r.n, right + r.right
            if right < bounds.precision * n:
                break
            thresholds[kind] = r.step / 100
    return Judge(trees, thresholds)


def selected(spans: DataFrame, judge: Judge | None) -> DataFrame:
    """The proposals with ``chosen``: base spans, and loose ones that reach the threshold of their kind."""
    if judge is None:
        return spans.withColumn("chosen", F.coalesce("base", F.lit(False)))
    limit = F.lit(2.0)
    for kind, threshold in judge.thresholds.items():
        limit = F.when(F.col("kind") == kind, threshold).otherwise(limit)
    return judge.scored(spans).withColumn("chosen", F.col("kind").isNotNull() & (F.col("base") | (~F.col("ruled") & (F.col("score") >= limit))))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bounds: FitBounds = FitBounds()) -> DataFrame:
    """One row for each document: ``doc_id, text_hash``, ``base`` and ``spans``, sorted arrays of (start, k, kind, end)."""
    spans = cut(proposals(docs, id_col, text_col), "pii-proposals")
    marked = selected(spans, fit(spans, bounds))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    one = F.struct("start", rank.alias("k"), "kind", "end")
    rows = marked.groupBy("row", "doc_id", "text_hash").agg(
        F.array_sort(F.collect_list(F.when(F.col("chosen") & F.col("base"), one))).alias("base"),
        F.array_sort(F.collect_set(F.when(F.col("chosen") & ~F.col("base"), one))).alias("loose"),
    )
    apart = F.filter("loose", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return rows.select("doc_id", "text_hash", "base", F.array_sort(F.concat("base", apart)).alias("spans"))


def number(kind: str) -> Column:
    """Base spans of a kind."""
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def as_text(spans: Column) -> Column:
    """``kind:start:end`` by start, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


#: Code points of the blocks in which a text is rebuilt; a span is cut out of its block, not out of the text.
BLOCK = 2048


def _by_block(spans: DataFrame, keys: list[str], name: str) -> DataFrame:
    """For each document a map from the number of a block to the spans that touch it, each with ``reach``, where the
    spans before it end. Spans are numbered over narrow rows, so a document with very many is no square."""
    each = spans.select(*keys, F.explode(name).alias("s"))
    earlier = Window.partitionBy(*keys).orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("s.end").over(earlier), F.lit(0).cast("long")).alias("reach")
    touched = F.sequence(F.floor(F.col("start") / BLOCK), F.floor((F.col("end") - 1) / BLOCK))
    placed = each.select(*keys, "s.start", "s.k", "s.kind", "s.end", reach).withColumn("block", F.explode(touched))
    lists = placed.groupBy(*keys, "block").agg(F.array_sort(F.collect_list(F.struct("start", "k", "kind", "end", "reach"))).alias("own"))
    return lists.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("block", "own"))).alias(name))


def masked(text: Column, by_block: Column) -> Column:
    """``text`` with each run of overlapping spans (see ``_by_block``) replaced by the mask of its first span."""
    blocks = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def rebuilt(block: Column, b: Column) -> Column:
        low = b.cast("long") * BLOCK
        own = F.element_at(by_block, b.cast("long"))

        def piece(s: Column) -> Column:
            start = F.greatest(s["reach"], low)
            before = F.when(s["start"] > start, F.substring(block, (start - low + 1).cast("int"), (s["start"] - start).cast("int"))).otherwise("")
            first = (s["start"] >= low) & (s["reach"] <= s["start"])
            return F.concat(before, F.when(first, F.concat(F.lit("<"), s["kind"], F.lit(">"))).otherwise(""))

        end = F.array_max(F.transform(own, lambda s: s["end"])) - low
        tail = F.substring(block, (F.least(end, F.lit(BLOCK).cast("long")) + 1).cast("int"), F.lit(BLOCK))
        return F.when(own.isNull(), block).otherwise(F.concat(F.array_join(F.transform(own, piece), ""), tail))

    return F.array_join(F.transform(blocks, rebuilt), "")


def redact(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the spans of ``found`` (see ``find``) masked in the text; null texts stay null."""
    own_id, own_hash, own = (free(docs, name) for name in ("_id", "_hash", "_spans"))
    spans = found.filter(F.size("spans") > 0).select(F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash), F.col("spans").alias(own)).dropDuplicates([own_id, own_hash])
    on = F.col(id_col).cast("long").eqNullSafe(F.col(own_id)) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(own_hash))
    joined = docs.join(_by_block(spans, [own_id, own_hash], own), on, "left")
    text = F.when(F.col(own).isNotNull(), masked(F.col(text_col), F.col(own))).otherwise(F.col(text_col))
    return joined.withColumn(text_col, text).select(*docs.columns)
