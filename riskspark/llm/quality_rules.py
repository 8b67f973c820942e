"""Quality rules learned as a decision list. DataFrame functions only.

Statistics of whole texts are columns. From a bounded sample of labelled documents, sequential covering grows one
conjunction of thresholds after the other: each step takes the condition with the best information gain on two thirds
of the sample, each finished rule loses trailing conditions that do not help on the last third, and covered rows leave.
Rules below `precision` end the search. Only counts per statistic and threshold reach the driver. The list is emitted
as an ordered Spark conditional expression over the statistics.

Nulls and ties: null text has no words and fails the base rules. Rows with null or repeated ids are judged one by one.
Equal gains go to the earlier statistic and lower threshold. Without labelled rows the list is empty and the base rules
decide. All columns of the input pass through `keep_good`, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.labelled import training_texts
from riskspark.session import stored

WHITE = r"[\x20\x09-\x0D]+"
FEATURES = ["symbol_share", "mark_share", "bar_share", "upper_share", "distinct_share", "same_share", "repeat_share", "dup_line_share", "word_chars_mean", "log_words"]
BINS = 40


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        return F.col(self.feature) > self.cut if self.above else F.col(self.feature) <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def covered(rule: Rule) -> Column:
    out = F.lit(True)
    for condition in rule:
        out = out & condition.column()
    return out


def with_repeated_words(rows: DataFrame, width: int = 3) -> DataFrame:
    """Adds n_repeat_words: words that lie in a window of three words which array `words` holds more than once.

    Each step is a column of its own: an expression inside a lambda would be evaluated for every element.
    """
    spans = F.size("words") - width + 1
    rows = rows.withColumn("hashes", F.transform(F.slice("words", 1, F.greatest(spans, F.lit(0))), lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2))))
    again = F.size(F.array_distinct("hashes")) < F.size("hashes")
    pairs = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("ordered", F.when(again, pairs).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    # Neighbours in the order with one hash are the same window at two places.
    both = F.zip_with("ordered", F.slice("ordered", 2, F.greatest(F.size("ordered"), F.lit(1))), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    rows = rows.withColumn("places", F.sort_array(F.array_distinct(F.flatten(F.filter(both, lambda p: p.isNotNull())))))
    # A place adds as many words as lie between it and the place before, three at most.
    gaps = F.zip_with("places", F.slice("places", 2, F.greatest(F.size("places"), F.lit(1))), lambda a, b: F.least(F.lit(width), F.coalesce(b - a, F.lit(width))))
    count = F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)
    return rows.withColumn("n_repeat_words", count.cast("bigint")).drop("hashes", "ordered", "places")


def with_statistics(docs: DataFrame) -> DataFrame:
    """`docs` (with column text) plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and FEATURES."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.withColumn("text", text).withColumn("words", F.filter(F.split("text", WHITE, -1), lambda w: w != ""))
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    rows = rows.select(
        "*",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
    )
    rows = with_repeated_words(rows)
    n, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.length("text"), F.lit(1))
    tally = lambda sign: F.length("text") - F.length(F.replace(F.col("text"), F.lit(sign), F.lit("")))
    pairs = F.zip_with("words", F.slice("words", 2, F.greatest(F.size("words"), F.lit(1))), lambda a, b: F.when(a == b, 1))
    rows = rows.select(
        "*",
        (F.col("n_symbols") / n).alias("symbol_share"),
        (tally("!") / n).alias("mark_share"),
        (tally("|") / n).alias("bar_share"),
        (F.regexp_count("text", F.lit(r"\p{Lu}")) / chars).alias("upper_share"),
        (F.size(F.array_distinct("words")) / n).alias("distinct_share"),
        (F.size(F.filter(pairs, lambda same: same.isNotNull())) / n).alias("same_share"),
        (F.col("n_repeat_words") / n).alias("repeat_share"),
        (F.col("n_dup_lines") / F.greatest(F.size("lines"), F.lit(1))).alias("dup_line_share"),
        (F.col("word_chars") / n).alias("word_chars_mean"),
        F.log1p(F.col("n_words").cast("double")).alias("log_words"),
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
    )
    return rows.drop("words", "lines")


def cuts_of(sample: DataFrame) -> dict[str, list[float]]:
    """At most BINS - 1 thresholds per statistic."""
    shares = [k / BINS for k in range(1, BINS)]
    row = sample.agg(*(F.percentile_approx(f, shares, 2_000).alias(f) for f in FEATURES)).first()
    return {f: sorted(set(row[f] or [])) for f in FEATURES}


def at_most(feature: str):
    """Thresholds that lie below the value of a statistic; their number is its bin."""
    return lambda cut: cut < F.col(feature)


def tallies(sample: DataFrame, rule: Rule, cuts: dict[str, list[float]]) -> dict[tuple[str, int], list[int]]:
    """Bad and good rows that `rule` covers, by statistic and bin, in the growing part."""
    rows = sample.filter("grow").filter(covered(rule))
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f"bin_{f}").alias("bin")) for f in FEATURES)))
    counts = rows.select("bad", each.alias("e")).groupBy("e.feature", "e.bin").agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good"))
    return {(r["feature"], r["bin"]): [r["bad"], r["good"]] for r in counts.collect()}  # FEATURES times BINS rows at most


def information(bad: float, good: float) -> float:
    return math.log2(bad / (bad + good)) if bad else -math.inf


def best_condition(counts: dict, cuts: dict[str, list[float]], least: int) -> tuple[float, Condition] | None:
    """Condition with the largest information gain for the bad rows."""
    found = None
    for f in FEATURES:
        table = [counts.get((f, b), [0, 0]) for b in range(len(cuts[f]) + 1)]
        bad, good = sum(t[0] for t in table), sum(t[1] for t in table)
        low_bad = low_good = 0
        for b, cut in enumerate(cuts[f]):
            low_bad, low_good = low_bad + table[b][0], low_good + table[b][1]
            for above, p, n in ((False, low_bad, low_good), (True, bad - low_bad, good - low_good)):
                if p >= least and p + n < bad + good:
                    gain = p * (information(p, n) - information(bad, good))
                    if found is None or gain > found[0] + 1e-9:
                        found = (gain, Condition(f, above, float(cut)))
    return found


def prune(sample: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """Shortest prefix with the best value on the pruning part, and the bad and good rows it covers there."""
    heads = [rule[: k + 1] for k in range(len(rule))]
    sums = [F.sum(F.when(covered(h), F.col(c) if c == "bad" else 1 - F.col("bad")).otherwise(0)).alias(f"{c}_{k}") for k, h in enumerate(heads) for c in ("bad", "good")]
    row = sample.filter("NOT grow").agg(*sums).first()
    value = lambda k: ((row[f"bad_{k}"] or 0) - (row[f"good_{k}"] or 0) + 0.0) / ((row[f"bad_{k}"] or 0) + (row[f"good_{k}"] or 0) + 2.0)
    best = max(range(len(heads)), key=lambda k: (round(value(k), 9), -k))
    return heads[best], row[f"bad_{best}"] or 0, row[f"good_{best}"] or 0


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = 20_000, precision: float = 0.95, most_rules: int = 12, most_conditions: int = 3, least: int = 5) -> list[Rule]:
    """Rules for documents labelled 0, in order, from at most `sample` labelled documents that pass the base rules."""
    rows = with_statistics(training_texts(docs, labels, label, sample))
    rows = stored(rows.select((1 - F.col("label")).alias("bad"), (F.xxhash64(F.lit(7), "doc_id") % 3 != 0).alias("grow"), "base_failed", *FEATURES))
    rows = rows.filter("NOT base_failed").drop("base_failed")
    cuts = cuts_of(rows)
    binned = [F.size(F.filter(F.array(*map(F.lit, cuts[f])).cast("array<double>"), at_most(f))) for f in FEATURES]
    left = stored(rows.select("*", *(column.alias(f"bin_{f}") for column, f in zip(binned, FEATURES, strict=True))))
    rules: list[Rule] = []
    while len(rules) < most_rules:
        rule: Rule = ()
        while len(rule) < most_conditions:
            counts = tallies(left, rule, cuts)
            if rule and sum(good for _, good in counts.values()) == 0:
                break
            step = best_condition(counts, cuts, least)
            if step is None or step[0] <= 0:
                break
            rule = (*rule, step[1])
        if not rule:
            break
        rule, bad, good = prune(left, rule)
        if bad < 2 or bad < precision * (bad + good):
            break
        rules.append(rule)
        left = left.filter(~covered(rule))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The list as an ordered conditional expression: number of the rule that rejects, null if none does."""
    out = None
    for number, rule in enumerate(rules):
        out = F.when(covered(rule), number) if out is None else out.when(covered(rule), number)
    return F.lit(None).cast("int") if out is None else out


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, rule, kept."""
    rows = with_statistics(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    rows = rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", verdict(rules).alias("rule"))
    return rows.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def keep_good(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """`docs`, all columns, without what the base rules or the list reject."""
    rows = with_statistics(docs.select(F.struct("*").alias("row"), F.col("text").alias("text")))
    # The optimizer would copy the statistics into a filter that stands right above them; it leaves one on a running number in place.
    rows = rows.withColumn("number", F.monotonically_increasing_id())
    rows = rows.filter((F.col("number") >= 0) & ~F.col("base_failed") & verdict(rules).isNull())
    return rows.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
