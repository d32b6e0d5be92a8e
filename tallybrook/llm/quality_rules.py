"""Quality rules: a learned, ordered list of threshold conjunctions over text statistics.

Sequential covering: a rule that rejects grows by the condition of most
information gain, is pruned on rows it did not grow from, and is kept while it
is precise; the rows it covers are set aside and the next rule grows. What is
learned is a list of readable conditions, applied as one Spark CASE expression.
All work on rows is DataFrame functions: the driver sees counts per feature and
threshold only.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.text import once
from tallybrook.llm.shared import settled, words

WINDOW = 5
SYMBOLS = "[#*$%&|<>]"
# The labelled rows that rules are learned from are bounded by this number.
FIT_ROWS = 20_000
CUTS = 40
MAX_RULES = 12
MAX_CONDITIONS = 4
# A rule is kept when so many pruning rows fall under it, with at least this share of bad ones.
MIN_ROWS = 5
MIN_PRECISION = 0.95

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "n_words",
    "chars_per_word",
    "symbols_per_word",
    "dup_line_share",
    "repeat_share",
    "capital_share",
    "digit_share",
    "marks_per_word",
    "doubled_share",
)


class Condition(NamedTuple):
    feature: str
    above: bool
    threshold: float

    def column(self, stats: str) -> Column:
        value = F.col(stats)[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


class Rule(NamedTuple):
    """Documents that meet all conditions are rejected; counts are of the pruning rows."""

    conditions: tuple[Condition, ...]
    bad: int
    good: int

    def column(self, stats: str) -> Column:
        met = F.lit(True)
        for condition in self.conditions:
            met = met & condition.column(stats)
        return met

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def with_statistics(docs: DataFrame, text: str = "text", stats: str = "stats") -> DataFrame:
    """Two columns: `row`, the whole given row, and `stats`, what is counted in its text.

    A word is a run of characters other than the six spaces. `n_dup_lines` are
    lines with a word that equal an earlier line; `n_repeat_words` are words in
    windows of five that the text holds at least twice, the first included. A
    null or empty text has zero everywhere. Nothing is shuffled, and the work is
    n log n in the words of the longest text.
    """
    given = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    split = given.select("row", "text", once(words(F.col("text"))).alias("words"))
    split = split.select("row", "text", "words", once(F.transform("words", lambda word: F.xxhash64(word))).alias("hashes"))
    last = F.size("words") - WINDOW
    # A window's hash is made of those of its words, which are worked out once.
    windows = F.transform(
        F.sequence(F.lit(0), last), lambda at: F.xxhash64(*[F.get("hashes", at + i) for i in range(WINDOW)])
    )
    none = F.array().cast("array<bigint>")
    hashed = split.select("row", "text", "words", once(F.when(last >= 0, windows).otherwise(none)).alias("windows"))
    # Most texts hold no window twice and need no sorting.
    sorted_windows = F.array_sort(F.transform("windows", lambda h, at: F.struct(h.alias("h"), at.alias("at"))))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = hashed.select("row", "text", "words", once(F.when(repeats, sorted_windows)).alias("sorted"))

    def if_repeated(window, at):
        before = F.get(F.col("sorted"), at - 1)["h"] == window["h"]
        after = F.get(F.col("sorted"), at + 1)["h"] == window["h"]
        return F.when(F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False)), window["at"])

    found = F.filter(F.transform("sorted", if_repeated), lambda at: at.isNotNull())
    placed = ordered.select("row", "text", "words", once(F.sort_array(found)).alias("found"))
    # Each repeated window adds the words up to the next one, at most its own.
    next_ones = F.slice("found", F.lit(2), F.greatest(F.size("found"), F.lit(1)))
    gaps = F.zip_with("found", next_ones, lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)
    followers = F.slice("words", F.lit(2), F.greatest(F.size("words"), F.lit(1)))
    doubled = F.zip_with("words", followers, lambda a, b: a.eqNullSafe(b))
    has_word = r"[^ \t\n\x0B\f\r]"
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(has_word))
    counted = placed.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.regexp_count("text", F.lit("[A-Z]")).alias("_capitals"),
        F.regexp_count("text", F.lit("[0-9]")).alias("_digits"),
        F.regexp_count("text", F.lit("[.,;:!?]")).alias("_marks"),
        F.size(F.filter(doubled, lambda same: same)).alias("_doubled"),
        once(lines).alias("_lines"),
    )
    n_lines = F.size("_lines")
    dup_lines = n_lines - F.size(F.array_distinct("_lines"))

    def share(part: Column, whole: Column) -> Column:
        return (part / F.greatest(whole, F.lit(1))).cast("double")

    n_words, word_chars = F.col("n_words"), F.col("word_chars")
    columns = {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": F.col("n_symbols"),
        "n_dup_lines": dup_lines.cast("long"),
        "n_repeat_words": F.col("n_repeat_words"),
        "chars_per_word": share(word_chars, n_words),
        "symbols_per_word": share(F.col("n_symbols"), n_words),
        "dup_line_share": share(dup_lines, n_lines),
        "repeat_share": share(F.col("n_repeat_words"), n_words),
        "capital_share": share(F.col("_capitals"), word_chars),
        "digit_share": share(F.col("_digits"), word_chars),
        "marks_per_word": share(F.col("_marks"), n_words),
        "doubled_share": share(F.col("_doubled"), n_words),
    }
    return counted.select("row", once(F.struct(*[c.alias(n) for n, c in columns.items()])).alias(stats))


def base_failed(stats: str = "stats") -> Column:
    """Too few words, or over a fifth of the words in repeated windows."""
    s = F.col(stats)
    return (s["n_words"] < 10) | (100 * s["n_repeat_words"] > 20 * s["n_words"])


def _gain(bad: int, good: int, bad_before: int, good_before: int) -> float:
    """FOIL's information gain of going from the counts before to the new ones."""
    if bad == 0:
        return 0.0
    now = math.log2(bad / (bad + good))
    return bad * (now - math.log2(bad_before / (bad_before + good_before)))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    fit_rows: int = FIT_ROWS,
    max_rules: int = MAX_RULES,
) -> list[Rule]:
    """Rules for rejecting what is labelled 0, learned from labelled documents.

    At most `fit_rows` labelled ids are used, those of the smallest hashes; with
    them as the bounded, broadcast side, only their texts are read on. Labels
    that are null or lack an id count for nothing, and an id with several labels
    is bad if one of them is. Without labels, or with one kind only, there are no
    rules. Two thirds of the rows grow rules and one third prunes them.
    """
    sample = (
        labels.where(F.col(key).isNotNull() & F.col(quality).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.min(quality).alias("_quality"))
        .orderBy(F.xxhash64("_key"), "_key")
        .limit(fit_rows)
    )
    joined = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(sample), "_key")
    counted = with_statistics(joined, "_text")
    rows = settled(
        counted.where(~base_failed()).select(
            (F.col("row")["_quality"] == 0).alias("bad"),
            (F.pmod(F.xxhash64(F.col("row")["_key"], F.lit(1)), F.lit(3)) == 0).alias("prunes"),
            F.struct(*[F.col("stats")[f].cast("double").alias(f) for f in FEATURES]).alias("stats"),
        ),
        "quality-rules",
        gather=True,
    )
    shares = [i / CUTS for i in range(1, CUTS)]
    tops = rows.where("bad").agg(*[F.percentile_approx(F.col("stats")[f], shares, 1000).alias(f) for f in FEATURES]).first()
    alls = rows.agg(*[F.percentile_approx(F.col("stats")[f], shares, 1000).alias(f) for f in FEATURES]).first()
    cuts = {f: sorted({*(tops[f] or ()), *(alls[f] or ())}) for f in FEATURES}
    # Thresholds lie between the values, so that a rule does not end on a single value.
    cuts = {f: sorted({*v, *((a + b) / 2 for a, b in zip(v, v[1:], strict=False))}) for f, v in cuts.items()}
    bins = F.array(*[F.struct(F.lit(f).alias("feature"), _bin(f, cuts[f]).alias("bin")) for f in FEATURES])
    rows = settled(rows.select("bad", "prunes", "stats", bins.alias("bins")), "quality-bins")
    rules: list[Rule] = []
    left = rows
    while len(rules) < max_rules:
        rule = _grown(left, cuts)
        if rule is None:
            break
        rules.append(rule)
        left = left.where(~rule.column("stats"))
    return rules


def _bin(feature: str, cuts: list[float], stats: str = "stats") -> Column:
    """How many of the cuts lie below the value."""
    value = F.col(stats)[feature]
    below = F.filter(F.array(*[F.lit(float(c)) for c in cuts]).cast("array<double>"), lambda cut: cut < value)
    return F.size(below)


def _grown(rows: DataFrame, cuts: dict[str, list[float]]) -> Rule | None:
    """The next rule over the rows that no rule covers yet, pruned; None if none is precise."""
    conditions: list[Condition] = []
    best: Rule | None = None
    best_worth = 0.0
    while len(conditions) < MAX_CONDITIONS:
        counted = (
            rows.where(Rule(tuple(conditions), 0, 0).column("stats"))
            .select("bad", "prunes", F.explode("bins").alias("at"))
            .groupBy("at.feature", "at.bin")
            .agg(
                F.count_if(F.col("bad") & ~F.col("prunes")).alias("bad"),
                F.count_if(~F.col("bad") & ~F.col("prunes")).alias("good"),
                F.count_if(F.col("bad") & F.col("prunes")).alias("prune_bad"),
                F.count_if(~F.col("bad") & F.col("prunes")).alias("prune_good"),
            )
            .collect()  # one row per feature and bin
        )
        table = {(r["feature"], r["bin"]): tuple(r)[2:] for r in counted}
        whole = [sum(v[i] for (f, _), v in table.items() if f == FEATURES[0]) for i in range(4)]
        if whole[0] == 0 or whole[1] == 0:
            break
        choices = []
        for feature in FEATURES:
            low = [0, 0, 0, 0]
            for at, cut in enumerate(cuts[feature]):
                low = [a + b for a, b in zip(low, table.get((feature, at), (0, 0, 0, 0)), strict=True)]
                high = [a - b for a, b in zip(whole, low, strict=True)]
                for above, side in ((False, low), (True, high)):
                    gain = _gain(side[0], side[1], whole[0], whole[1])
                    choices.append((gain, Condition(feature, above, cut), side))
        gain = max(choices)[0]
        equal = [c for c in choices if c[0] == gain and c[1][:2] == max(choices)[1][:2]]
        # Where several thresholds part the growing rows alike, the one in the middle.
        gain, condition, side = equal[len(equal) // 2]
        if gain <= 0:
            break
        conditions.append(condition)
        bad, good = side[2], side[3]
        worth = (bad - good) / (bad + good) if bad + good >= MIN_ROWS else 0.0
        if worth > best_worth:
            best_worth, best = worth, Rule(tuple(conditions), bad, good)
    if best is None or best.bad < MIN_PRECISION * (best.bad + best.good):
        return None
    return best


def verdict(rules: list[Rule], stats: str = "stats") -> Column:
    """The first rule that a document meets, as text; null if it meets none."""
    found = F.lit(None).cast("string")
    for rule in reversed(rules):
        found = F.when(rule.column(stats), F.lit(str(rule))).otherwise(found)
    return found


def judged(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """Columns `row`, `stats`, `base_failed`, `rule` (the rule met) and `kept`."""
    counted = with_statistics(docs, text)
    found = counted.withColumns({"base_failed": base_failed(), "rule": verdict(rules)})
    return found.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def kept(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """The documents that stay, with their own columns."""
    return judged(docs, rules, text).where("kept").select("row.*")
