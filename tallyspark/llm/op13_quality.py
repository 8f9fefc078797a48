"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Every text gets its base counts (words, code points in words, symbols,
repeated lines, words in repeated three-word windows). What passes the base
limits goes through a list of rules, each a boolean column of the text, its
words and its counts. A text is rejected by the first rule that it fails and the rules behind
that one are never evaluated for it (the branches of one CASE).

The order of the rules comes from a sample: each rule is timed over the stored
sample, one count gives the joint outcomes of all rules, and then the rule with
the most rejections per cost among what is still left comes next, again and
again. Outcomes are counts of at most 2 ** rules combinations, whatever the
sample. The order changes the time and the name of the rule that a text failed
first, never the verdict.

Defined cases: a null text has no words and counts of 0, and fails; a rule that
is null for a text doesn't reject it; repeated ids and rows are judged each;
extra columns are not touched (the result has the columns of ``keep`` and those
named below); an empty table gives an empty result and keeps the given order.
"""
from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Character classes of regular expressions.
SYMBOLS = r"#*$%&|<>"
BLANK = r"\x20\x09-\x0D"
MIN_WORDS, REPEAT_PERCENT = 50, 50
#: Rows that the order of the rules is estimated on, about; each rule is timed so many times over so many copies of them.
SAMPLE_ROWS, TIMES, COPIES = 1000, 2, 4
#: Seconds below which the timing of a rule is noise.
LEAST_COST = 0.01


@dataclass(frozen=True)
class Rule:
    """``fails(x)`` is true for a text that the rule rejects; x has the columns
    of ``COUNTS``."""
    name: str
    fails: Callable[[SimpleNamespace], Column]


def words_of(text: Column) -> Column:
    """Runs of characters other than the space and 9 to 13."""
    return F.array_remove(F.split(text, f"[{BLANK}]+"), "")


def occurring(text: Column, characters: str) -> Column:
    """How many characters of the class ``characters`` stand in the text."""
    return F.length(F.regexp_replace(text, f"[^{characters}]+", ""))


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{BLANK}]"))


def word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, ""))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = lines_with_words(text)
    return F.size(lines) - F.size(F.array_distinct(lines))


def sorted_windows(words: Column, joined: Callable[[Column, Column], Column] = lambda a, b: F.xxhash64(a, b)) -> Column:
    """Keys (g) and places (i) of the three-word windows, sorted; ``joined``
    makes a key of two words or keys."""
    n = F.size(words)
    second, third = F.slice(words, 2, F.greatest(n, F.lit(1))), F.slice(words, 3, F.greatest(n, F.lit(1)))
    keys = F.slice(F.zip_with(F.zip_with(words, second, joined), third, joined), 1, F.greatest(n - 2, F.lit(0)))
    return F.sort_array(F.transform(keys, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))


def neighbours(ordered: Column) -> Column:
    """Pairs of places (i, j) that are next to each other and have one key."""
    later = F.slice(ordered, 2, F.greatest(F.size(ordered), F.lit(1)))
    both = F.zip_with(ordered, later, lambda a, b: F.when(a.g == b.g, F.struct(a.i.alias("i"), b.i.alias("j"))))
    return F.filter(both, lambda x: x.isNotNull())


def covered(pairs: Column) -> Column:
    """Places inside the windows that ``pairs`` name."""
    return F.size(F.array_distinct(F.flatten(F.transform(pairs, lambda p: F.array(p.i, p.i + 1, p.i + 2, p.j, p.j + 1, p.j + 2)))))


def repeated_words(words: Column, pairs: Column) -> Column:
    """Words inside windows that stand twice or more. ``pairs`` come from
    hashes; where two windows of a pair differ, the words themselves are
    sorted instead (no word holds a space, so joined words are exact keys)."""
    def differs(p: Column) -> Column:
        return ~(((words[p.i] == words[p.j]) & (words[p.i + 1] == words[p.j + 1])) & (words[p.i + 2] == words[p.j + 2]))
    exact = covered(neighbours(sorted_windows(words, lambda a, b: F.concat_ws(" ", a, b))))
    return F.when(F.exists(pairs, differs), exact).otherwise(covered(pairs))


def share(part: Column, whole: Column, most: float) -> Column:
    return part > most * whole


def lines(select: Callable[[Column], Column], most: float) -> Callable[[SimpleNamespace], Column]:
    """Rejects where more than ``most`` of the lines with words are such."""
    return lambda x: share(F.size(F.filter(lines_with_words(x.text), select)), F.size(lines_with_words(x.text)), most)


#: The rules of the query. Limits are shares of words, characters in words, or lines.
RULES = (
    Rule("symbols", lambda x: share(x.n_symbols, x.n_words, 0.1)),
    Rule("word length", lambda x: ~(x.word_chars / x.n_words).between(3, 15)),
    Rule("repeated lines", lambda x: share(x.n_dup_lines, F.size(lines_with_words(x.text)), 0.5)),
    Rule("exclamation marks", lambda x: share(occurring(x.text, "!"), x.n_words, 0.3)),
    Rule("capitals", lambda x: share(occurring(x.text, "A-Z"), x.word_chars, 0.4)),
    Rule("digits", lambda x: share(occurring(x.text, "0-9"), x.word_chars, 0.3)),
    Rule("words without letters", lambda x: share(F.size(F.filter(x.words, lambda w: ~w.rlike(r"\p{L}"))), x.n_words, 0.3)),
    Rule("cut lines", lines(lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"), 0.3)),
    Rule("bullet lines", lines(lambda x: F.substring(F.ltrim(x), 1, 1).isin("-", "•", "·", "*"), 0.9)),
)


def with_counts(docs: DataFrame, keep: Sequence[str] = (), text_col: str = "text") -> DataFrame:
    """One row per text: the struct ``kept_columns``, text, words and the base counts."""
    w, t = F.col("words"), F.col("text")
    kept = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.lit(None)
    x = docs.select(kept.alias("kept_columns"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    # each step's arrays are columns of their own, so that the next one reads them by place
    x = x.select("kept_columns", "text", words_of(t).alias("words"))
    x = x.select("kept_columns", "text", "words", sorted_windows(w).alias("ordered"))
    x = x.select("kept_columns", "text", "words", neighbours(F.col("ordered")).alias("pairs"))
    counts = F.struct(F.size(w).cast("long").alias("n_words"), word_chars(w).cast("long").alias("word_chars"),
                      occurring(t, SYMBOLS).cast("long").alias("n_symbols"), duplicate_lines(t).cast("long").alias("n_dup_lines"),
                      repeated_words(w, F.col("pairs")).cast("long").alias("n_repeat_words"))
    # a generated column: filters on counts stay above it and don't work through the arrays again
    return x.select("kept_columns", "text", "words", F.explode(F.array(counts)).alias("counts")).select("kept_columns", "text", "words", "counts.*")


#: What a rule may read.
COUNTS = ("text", "words", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def reads() -> SimpleNamespace:
    return SimpleNamespace(**{c: F.col(c) for c in COUNTS})


def base_failed(min_words: int = MIN_WORDS, repeat_percent: int = REPEAT_PERCENT) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))


def first_failed(rules: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects; later rules are not evaluated."""
    out = F
    for r in rules:
        out = out.when(r.fails(reads()), F.lit(r.name))
    return out if rules else F.lit(None).cast("string")


def greedy(rules: Sequence[Rule], cost: dict[str, float], outcomes: Sequence[tuple[Sequence[bool], int]]) -> list[Rule]:
    """Rules by rejections per cost among the rows that earlier ones left.
    ``outcomes`` holds the rules' results (in the order of ``rules``) and the
    rows that have them; ties go to the cheaper rule, then to the given order."""
    left, out = list(enumerate(rules)), []
    while left:
        rejected = {i: sum(n for failed, n in outcomes if failed[i]) for i, _ in left}
        i, r = max(left, key=lambda x: (rejected[x[0]] / cost[x[1].name], -cost[x[1].name], -x[0]))
        left.remove((i, r))
        out.append(r)
        outcomes = [(failed, n) for failed, n in outcomes if not failed[i]]
    return out


def order_by_sample(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", sample_rows: int = SAMPLE_ROWS,
                    seed: int = 13, passed: Column | None = None) -> tuple[list[Rule], dict[str, float]]:
    """The cascade's order and each rule's seconds over the sample, which has
    about ``sample_rows`` rows whatever the size of ``docs``. ``passed``: which
    rows reach the cascade."""
    total = docs.count()
    chosen = docs.select(text_col).where(F.col(f"`{text_col}`").isNotNull()).sample(min(1.0, sample_rows / max(total, 1)), seed)
    sample = common.store(with_counts(chosen, text_col=text_col).drop("kept_columns").where(F.lit(True) if passed is None else passed), "quality-sample").coalesce(1)
    copies = sample.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES))))

    def seconds(column: Column) -> float:
        times = []
        for _ in range(TIMES):
            began = time.perf_counter()
            copies.agg(F.count_if(column), F.sum(F.size("words")), F.sum(F.length("text"))).collect()
            times.append(time.perf_counter() - began)
        return min(times)

    seconds(F.lit(False))
    nothing = seconds(F.lit(False))
    cost = {r.name: max(seconds(r.fails(reads())) - nothing, LEAST_COST) for r in rules}
    found = sample.groupBy(F.array(*[F.coalesce(r.fails(reads()), F.lit(False)) for r in rules]).alias("failed")).count()
    return greedy(rules, cost, [(x.failed, x["count"]) for x in found.collect()]), cost


def judge(docs: DataFrame, rules: Sequence[Rule] | None = None, keep: Sequence[str] = ("doc_id",), text_col: str = "text",
          min_words: int = MIN_WORDS, repeat_percent: int = REPEAT_PERCENT) -> DataFrame:
    """Per row of ``docs``: the columns of ``keep``, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, failed_rule (the first
    rule that rejects; null for kept texts and base failures) and kept.

    ``rules`` in the order given; None: RULES in the order that a sample of
    ``docs`` suggests.
    """
    failed = base_failed(min_words, repeat_percent)
    if rules is None:
        rules, _ = order_by_sample(docs, text_col=text_col, passed=~failed)
    x = with_counts(docs, keep, text_col).withColumn("base_failed", failed)
    x = x.withColumn("failed_rule", F.when(~F.col("base_failed"), first_failed(rules)))
    return x.select("kept_columns.*", *COUNTS[2:], "base_failed", "failed_rule", (~F.col("base_failed") & F.col("failed_rule").isNull()).alias("kept"))
