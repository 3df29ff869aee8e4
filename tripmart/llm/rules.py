"""Quality rules: counts per document and a decision list learned from labels.

Written with DataFrame functions only; the covering loop sees a bounded number of
labelled statistics.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import log2
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_SPACE, WORD_SPACE_PATTERN, let, spare

# Fixed values of the base rules.
MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30
SYMBOLS = r"[#*$%&|<>]+"
# At most this many labelled documents are learned from, the first by hash of their key.
MAX_LABELLED = 4000
# A rule must be right this often on what it covers, and cover so many rejects.
MIN_PRECISION, MIN_COVERED = 0.97, 3
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(words: Column) -> Column:
    """Words inside windows of eight that the text has twice or more."""

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            def twice(x: Column, i: Column) -> Column:
                before = F.get(s, i - 1)["h"] == x["h"]
                after = F.get(s, i + 1)["h"] == x["h"]
                return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

            return F.sort_array(F.transform(F.filter(s, twice), lambda x: x["i"]))

        def length(at: Column) -> Column:
            steps = F.transform(
                at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW)))
            )
            return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

        return let(placed, lambda s: let(positions(s), length))

    def follow(hashes: Column, by: int) -> Column:
        return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + by)))

    # Hashes of 2, 4 and 8 words, each of two shorter ones.
    eight = let(
        follow(words, 1),
        lambda two: let(
            follow(two, 2),
            lambda four: F.transform(
                F.slice(four, F.lit(1), F.size(words) - WINDOW + 1),
                lambda h, i: F.xxhash64(h, F.get(four, i + 4)),
            ),
        ),
    )
    repeats = let(
        eight,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)),
    )
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(repeats)


def _removed(body: Column, pattern: str) -> Column:
    return F.length(body) - F.length(F.regexp_replace(body, pattern, ""))


def statistics(text: Column) -> Column:
    """Struct of whole-text counts; null and empty texts have none of anything."""
    body = F.coalesce(text, F.lit(""))
    trimmed = F.btrim(body, F.lit(WORD_SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, WORD_SPACE_PATTERN)
    )
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    by_word = let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
        ),
    )
    by_line = let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    return F.struct(
        by_word.alias("word"),
        by_line.alias("line"),
        _removed(body, SYMBOLS).cast("long").alias("n_symbols"),
        _removed(body, r"!+").cast("long").alias("n_bangs"),
        _removed(body, r"\p{Lu}+").cast("long").alias("n_upper"),
        _removed(body, r"[0-9]+").cast("long").alias("n_digits"),
    )


def measured(docs: DataFrame, text: str, name: str) -> DataFrame:
    """``docs`` with a struct column of counts and shares.

    The one-element generators keep later filters from repeating the counting.
    """
    raw = spare(docs, "raw_counts")[0]
    counted = docs.withColumn(raw, F.explode(F.array(statistics(F.col(f"`{text}`")))))
    s = F.col(raw)
    words, chars = s["word"]["n_words"], s["word"]["word_chars"]

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    fields = {
        "n_words": words,
        "word_chars": chars,
        "n_symbols": s["n_symbols"],
        "n_dup_lines": s["line"]["n_dup_lines"],
        "n_repeat_words": s["word"]["n_repeat_words"],
        "base_failed": (words < MIN_WORDS)
        | (100 * s["word"]["n_repeat_words"] > MAX_REPEAT_PERCENT * words),
        "symbol_share": share(s["n_symbols"], words),
        "bang_share": share(s["n_bangs"], words),
        "upper_share": share(s["n_upper"], chars),
        "digit_share": share(s["n_digits"], chars),
        "mean_word": share(chars, words),
        "dup_line_share": share(s["line"]["n_dup_lines"], s["line"]["n_lines"]),
        "repeat_share": share(s["word"]["n_repeat_words"], words),
    }
    made = F.struct(*[c.alias(n) for n, c in fields.items()])
    return counted.withColumn(name, F.explode(F.array(made))).drop(raw)


FEATURES = (
    "symbol_share", "bang_share", "upper_share", "digit_share", "mean_word",
    "dup_line_share", "repeat_share",
)


class Condition(NamedTuple):
    feature: str
    above: bool
    threshold: float

    def holds(self, row: dict[str, float]) -> bool:
        return (row[self.feature] > self.threshold) == self.above

    def column(self, stats: Column) -> Column:
        value = stats[self.feature]
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]
Labelled = list[tuple[dict[str, float], bool]]


def covers(rule: Rule, row: dict[str, float]) -> bool:
    return all(c.holds(row) for c in rule)


def _best_condition(rows: Labelled) -> Condition | None:
    """The condition with the largest information gain for the rejects it keeps."""
    rejects = sum(bad for _, bad in rows)
    base = log2(rejects / len(rows))
    best, best_gain = None, 1e-9
    for feature in FEATURES:
        values = sorted((x[feature], bad) for x, bad in rows)
        below = bad_below = 0
        for i in range(len(values) - 1):
            below += 1
            bad_below += values[i][1]
            if values[i][0] == values[i + 1][0]:
                continue
            threshold = (values[i][0] + values[i + 1][0]) / 2
            for above, n, bad in (
                (False, below, bad_below),
                (True, len(values) - below, rejects - bad_below),
            ):
                gain = bad * (log2(bad / n) - base) if bad else 0.0
                if gain > best_gain:
                    best, best_gain = Condition(feature, above, threshold), gain
    return best


def _precision(rule: Rule, rows: Labelled) -> tuple[float, int]:
    hit = [bad for x, bad in rows if covers(rule, x)]
    return (sum(hit) / len(hit) if hit else 0.0), sum(hit)


def learn(rows: Labelled) -> list[Rule]:
    """Rules that reject, in the order found (sequential covering).

    A rule is grown on two thirds of what is not yet covered, by conditions of the
    largest gain until it covers rejects only, then loses last conditions as long
    as that does not worsen its value on the other third.  The list ends with the
    first rule that is too often wrong or covers too little.
    """
    rules: list[Rule] = []
    rest = list(rows)
    while sum(bad for _, bad in rest) >= MIN_COVERED:
        grow = [r for i, r in enumerate(rest) if i % 3] or rest
        prune = rest[::3]
        rule: Rule = ()
        covered = grow
        while any(bad for _, bad in covered) and not all(bad for _, bad in covered):
            condition = _best_condition(covered)
            if condition is None:
                break
            rule += (condition,)
            covered = [(x, bad) for x, bad in covered if condition.holds(x)]

        def value(candidate: Rule, held: Labelled = prune) -> float:
            hit = [bad for x, bad in held if covers(candidate, x)]
            return (2 * sum(hit) - len(hit)) / len(hit) if hit else -1.0

        while len(rule) > 1 and value(rule[:-1]) >= value(rule):
            rule = rule[:-1]
        precision, found = _precision(rule, rest) if rule else (0.0, 0)
        if precision < MIN_PRECISION or found < MIN_COVERED:
            break
        rules.append(rule)
        rest = [(x, bad) for x, bad in rest if not covers(rule, x)]
    return rules


def labelled_statistics(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, limit: int
) -> Labelled:
    """Shares and reject flag of at most ``limit`` labelled documents that pass the base rules."""
    id_ = F.col(f"`{key}`")
    sample = (
        labels.filter(id_.isNotNull() & F.col(label).isin(0, 1))
        .select(id_.alias("id"), (F.col(label) == 0).alias("reject"))
        .orderBy(F.xxhash64("id"), "id", "reject")
        .limit(limit)
    )
    texts = docs.select(id_.alias("id"), F.col(f"`{text}`").alias("text"))
    # At most ``limit`` rows by the line above.
    found = measured(texts.join(F.broadcast(sample), "id"), "text", "stats")
    rows = (
        found.filter(~F.col("stats")["base_failed"])
        .select(*[F.col("stats")[f].alias(f) for f in FEATURES], "id", "reject")
        .orderBy(F.xxhash64("id"), "id", *FEATURES, "reject")
        .limit(limit)
        .collect()
    )
    return [({f: r[f] for f in FEATURES}, r["reject"]) for r in rows]


def verdict(stats: Column, rules: Sequence[Rule]) -> Column:
    """Ordered conditional expression: base rules, then the learned ones, else kept."""
    decided = F.when(stats["base_failed"], F.lit(False))
    for rule in rules:
        decided = decided.when(
            reduce(lambda a, b: a & b, (c.column(stats) for c in rule)), F.lit(False)
        )
    return decided.otherwise(F.lit(True))


def judge(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """``docs`` with the counts, base_failed and kept.

    Labels are 1 (good) and 0 (reject) per key; others, and null keys, are left
    out.  Without labels, or where no rule is good enough, the base rules decide
    alone.  Null and empty texts have no words and fail.  Rows that repeat are
    judged each.  Columns named like the results are replaced, others stay.
    """
    fresh = {*COUNTS, "base_failed", "kept"}
    kept_names = [c for c in docs.columns if c.lower() not in fresh]
    rules = learn(labelled_statistics(docs, labels, key, text, label, max_labelled))
    (stats,) = spare(docs, "stats")
    found = measured(docs.select(*[F.col(f"`{c}`") for c in kept_names]), text, stats)
    s = F.col(stats)
    return found.select(
        *[F.col(f"`{c}`") for c in kept_names],
        *[s[c].alias(c) for c in COUNTS],
        s["base_failed"].alias("base_failed"),
        verdict(s, rules).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only."""
    (stats,) = spare(docs, "stats")
    rules = learn(labelled_statistics(docs, labels, key, text, "quality", MAX_LABELLED))
    found = measured(docs, text, stats)
    return found.filter(verdict(F.col(stats), rules)).drop(stats)
