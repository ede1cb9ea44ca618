"""Quality rules: text statistics, and a decision list learned from labels.

Sequential covering: a rule is a conjunction of thresholds on statistics. It is
grown on two thirds of the labelled documents, one threshold at a time, by
information gain; pruned from its end on the other third; kept if it is precise
there; and the next rule is grown on what no earlier rule covers. Every step
reads counts of (statistic, bin) that Spark has aggregated, at most a few
hundred numbers whatever the corpus. The list becomes one ordered Spark
conditional expression.

DataFrame functions only; statistics are computed where the text is read and no
text is moved.

Defined results: null or empty text has zero statistics and fails the base
rule; labels with a null id or quality are ignored, and a document with several
labels is poor if one says so; without labels of both kinds the list is empty
and only the base rule decides; ids may be null or repeat, each row is judged;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import common

REPEAT_WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Marks that count as symbols, and white space.
SYMBOLS, BLANKS = "#*$%&|<>", " \t\n\x0b\f\r"
QUANTILES = [0.002, 0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.82, 0.84, 0.86,
             0.88, 0.9, 0.91, 0.92, 0.93, 0.94, 0.95, 0.96, 0.97, 0.98, 0.99, 0.995, 0.998]
MAX_RULES, MAX_CONDITIONS, MIN_PRECISION, MIN_SHARE = 8, 3, 0.9, 0.005


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, evaluated once."""
    return F.transform(F.array(value), body)[0]


def _repeated(words: Column, n: int = REPEAT_WINDOW) -> Column:
    """How many words lie in windows of ``n`` words that the text has twice or
    more. Windows are told apart by a 64-bit hash within their text; the sort
    is left out where no two are equal."""
    def covered(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        places = _let(ordered, lambda s: F.sort_array(F.transform(F.filter(s, lambda x, i: (
            (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))), lambda x: x["i"])))
        steps = _let(places, lambda p: F.transform(
            p, lambda x, i: F.least(F.lit(n), F.coalesce(x - F.get(p, i - 1), F.lit(n)))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    def of(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*[w[i + k] for k in range(n)]))
        return F.when(F.size(w) > n, _let(hashes, lambda h: F.when(
            F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))).otherwise(0)

    return _let(words, of).cast("long")


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: the id, counts of words, characters, symbols, lines and
    repeats of the whole text, and base_failed."""
    text = F.col("text")
    has_word = lambda line: F.length(F.translate(line, BLANKS, "")) > 0
    lines = F.filter(F.split(text, "\n"), has_word)
    rows = docs.select(F.col(id_col).alias("id"), common.whole_text(text_col).alias("text")).select(
        "id", "text", F.translate(text, BLANKS, "").alias("solid"),
        F.filter(F.split(text, common.SPACE), lambda w: F.length(w) > 0).alias("words"))
    counted = rows.select(
        "id", F.size("words").cast("long").alias("n_words"), F.length("solid").cast("long").alias("word_chars"),
        (F.length("solid") - F.length(F.translate("solid", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                       F.size(F.array_distinct(x)).cast("long").alias("d"))).alias("lines"),
        _repeated(F.col("words")).alias("n_repeat_words"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct_words"),
        (F.length("solid") - F.length(F.regexp_replace("solid", "[A-Z]", ""))).cast("long").alias("n_upper"),
        (F.length("solid") - F.length(F.translate("solid", "!?", ""))).cast("long").alias("n_calls"))
    return counted.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols",
        (F.col("lines.n") - F.col("lines.d")).alias("n_dup_lines"), "n_repeat_words",
        F.col("lines.n").alias("n_lines"), "n_distinct_words", "n_upper", "n_calls",
        ((F.col("n_words") < MIN_WORDS) |
         (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"))


def measures() -> dict[str, Column]:
    """What rules may set thresholds on, from the columns of ``statistics``."""
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "distinct_share": share("n_distinct_words", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "calls_per_word": share("n_calls", "n_words"),
    }


@dataclass(frozen=True)
class Condition:
    measure: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = measures()[self.measure]
        return value >= self.threshold if self.at_least else value < self.threshold

    def __str__(self) -> str:
        return f"{self.measure} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Rejecting rules, in order; what no rule matches is kept."""
    rules: list[list[Condition]] = field(default_factory=list)

    def rejects(self) -> Column:
        verdict = None
        for rule in self.rules:
            matched = _all([c.column() for c in rule])
            verdict = F.when(matched, F.lit(True)) if verdict is None else verdict.when(matched, F.lit(True))
        return F.lit(False) if verdict is None else verdict.otherwise(False)

    def __str__(self) -> str:
        return "\n".join(f"{i + 1}. reject if {' and '.join(map(str, r))}" for i, r in enumerate(self.rules))


def _all(conditions: list[Column]) -> Column:
    found = F.lit(True)
    for c in conditions:
        found = found & c
    return found


def learn(labelled: DataFrame) -> DecisionList:
    """``labelled``: columns of ``statistics``, ``poor`` (boolean) and ``id``."""
    names = list(measures())
    values = labelled.select("id", "poor", *[m.alias(k) for k, m in measures().items()])
    cuts = values.agg(*[F.percentile_approx(k, QUANTILES, 10_000).alias(k) for k in names]).first()
    if cuts is None or cuts[0] is None:
        return DecisionList()
    points = {k: sorted(set(cuts[k])) for k in names}

    def bin_of(k: str) -> Column:
        """How many thresholds the value reaches."""
        value = F.col(k)
        return F.size(F.filter(F.array(*[F.lit(float(t)) for t in points[k]]), lambda t: value >= t)).alias(k)

    table = common.materialise(values.select(
        "poor", (F.pmod(F.xxhash64("id", F.lit(5)), F.lit(3)) < 2).alias("grow"),
        *map(bin_of, names)), "rules-bins")

    def column(c: Condition) -> Column:
        at = points[c.measure].index(c.threshold) + 1
        return F.col(c.measure) >= at if c.at_least else F.col(c.measure) < at

    def histogram(where: Column) -> dict[str, dict[int, tuple[int, int]]]:
        each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(k).alias("bin")) for k in names])).alias("e")
        rows = table.where(where).select("poor", each).groupBy("e.k", "e.bin").agg(
            F.count_if("poor").alias("p"), F.count_if(~F.col("poor")).alias("n")).collect()
        found: dict[str, dict[int, tuple[int, int]]] = {k: {} for k in names}
        for r in rows:
            found[r["k"]][r["bin"]] = (r["p"], r["n"])
        return found

    def best(counts, before: tuple[int, int]) -> tuple[float, Condition, tuple[int, int]] | None:
        top = None
        was = math.log2(before[0] / sum(before))
        for k in names:
            for at, threshold in enumerate(points[k], 1):
                above = [sum(v[i] for b, v in counts[k].items() if b >= at) for i in (0, 1)]
                for up, (p, n) in ((True, above), (False, [before[i] - above[i] for i in (0, 1)])):
                    if p and (gain := p * (math.log2(p / (p + n)) - was)) > 1e-9 and (top is None or gain > top[0]):
                        top = (gain, Condition(k, up, threshold), (p, n))
        return top

    total = table.agg(F.count_if("poor"), F.count_if(~F.col("poor"))).first()
    rules: list[list[Condition]] = []
    if not total[0] or not total[1]:
        return DecisionList()
    for _ in range(MAX_RULES):
        rest = ~_any([_all([column(c) for c in r]) for r in rules])
        rule: list[Condition] = []
        for _ in range(MAX_CONDITIONS):
            counts = histogram(F.col("grow") & rest & _all([column(c) for c in rule]))
            before = tuple(sum(v[i] for v in counts[names[0]].values()) for i in (0, 1))
            if not before[0] or not before[1]:
                break
            found = best(counts, before)
            if found is None:
                break
            rule.append(found[1])
        if not rule:
            break
        prefixes = [_all([column(c) for c in rule[:i + 1]]) for i in range(len(rule))]
        pruned = table.where(~F.col("grow") & rest).agg(*[
            F.count_if(p & (F.col("poor") if poor else ~F.col("poor"))) for p in prefixes for poor in (True, False)]).first()
        scored = [((p - n) / (p + n), -i, p, n) for i in range(len(rule))
                  if (p := pruned[2 * i]) + (n := pruned[2 * i + 1])]
        if not scored:
            break
        _, i, p, n = max(scored)
        if p / (p + n) < MIN_PRECISION or p < MIN_SHARE * total[0] / 3:
            break
        rules.append(rule[:1 - i])
    return DecisionList(rules)


def _any(conditions: list[Column]) -> Column:
    found = F.lit(False)
    for c in conditions:
        found = found | c
    return found


def learned(counted: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DecisionList:
    """From labels (id, quality 0/1) of documents that pass the base rule."""
    poor = labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull()).groupBy(
        F.col(id_col).alias("id")).agg(F.max(F.col("quality") == 0).alias("poor"))
    return learn(counted.where("not base_failed").withColumnRenamed(id_col, "id").join(poor, "id"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``statistics`` and kept."""
    counted = common.materialise(statistics(docs, id_col, text_col), "rules-statistics")
    rules = learned(counted, labels, id_col)
    return counted.withColumn("kept", ~F.col("base_failed") & ~rules.rejects())


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
