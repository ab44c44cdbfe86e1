"""Quality rules as learned decision lists.

Every document gets statistics of its text. From labelled documents a list of rules is learned by
sequential covering: a rule is a conjunction of thresholds, grown one condition at a time by the gain in
information on two thirds of the labelled rows, pruned on the other third, and kept only if it is
precise there; rows that it covers are set aside, and the next rule is grown. All candidate thresholds of
all features are counted in one aggregation, so the labelled rows never leave Spark. The list becomes
one conditional Spark expression.
"""

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetrove.llm.common import map_slices, same_row, utf8
from pagetrove.session import settled

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"
WINDOW = 5  # words
LEAST_WORDS = 10
MOST_REPEATED = 20  # percent of the words

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
          "n_marks", "n_distinct")


def repeated_words(words: list[bytes], window: int = WINDOW) -> tuple[int, int]:
    """Words that lie in a window of words found at least twice in the text, and distinct words."""
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    places = len(words) - window + 1
    if places < 2:
        return 0, len(known)
    codes, size = ids[:places], len(known)
    for step in range(1, window):
        if size > (1 << 62) // len(known):
            # Number the prefixes anew before the products overflow.
            names, codes = np.unique(codes, return_inverse=True)
            size = len(names)
        codes = codes * len(known) + ids[step:places + step]
        size *= len(known)
    order = np.argsort(codes, kind="stable")
    equal = codes[order[1:]] == codes[order[:-1]]
    twice = np.zeros(places, dtype=bool)
    twice[order[1:][equal]] = twice[order[:-1][equal]] = True
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    edges[:places] += twice
    edges[window:] -= twice
    return int((np.cumsum(edges) > 0).sum()), len(known)


def text_counts(text: bytes) -> tuple[int, ...]:
    """The values of COUNTS for one UTF-8 text."""
    words = text.split()
    letters = np.frombuffer(text, np.uint8)
    of = np.bincount(letters, minlength=256) if len(letters) < 1 << 24 else sum(
        np.bincount(letters[at:at + (1 << 24)], minlength=256) for at in range(0, len(letters), 1 << 24))
    points = len(letters) - int(of[0x80:0xC0].sum())
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeated, distinct = repeated_words(words)
    return (len(words), points - int(of[list(SPACES)].sum()), int(of[list(SYMBOLS)].sum()),
            len(lines) - len(set(lines)), repeated, len(lines), int(of[65:91].sum()),
            int(of[[33, 63]].sum()), distinct)


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, the counts) of every row of ``docs``; a null text counts as empty."""
    schema = "doc_id long, text_key long, " + ", ".join(f"{name} long" for name in COUNTS)

    def work(columns):
        ids, keys, texts = columns
        return [ids, keys, *(zip(*map(text_counts, texts)) if texts else [()] * len(COUNTS))]

    return map_slices(docs.select("doc_id", F.xxhash64("text").alias("text_key"), utf8("text")),
                      work, schema)


def _ratio(a, b):
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def features() -> dict[str, Column]:
    """What rules may test, by name, from the counts."""
    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": _ratio("word_chars", "n_words"),
        "symbol_share": _ratio("n_symbols", "word_chars"),
        "dup_line_share": _ratio("n_dup_lines", "n_lines"),
        "repeat_share": _ratio("n_repeat_words", "n_words"),
        "upper_share": _ratio("n_upper", "word_chars"),
        "mark_share": _ratio("n_marks", "n_words"),
        "distinct_share": _ratio("n_distinct", "n_words"),
        "words_per_line": _ratio("n_words", "n_lines"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature > edge, else feature <= edge
    edge: float

    def column(self, of: dict[str, Column]) -> Column:
        return of[self.feature] > self.edge if self.above else of[self.feature] <= self.edge


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    bad: int  # rows of the pruning part that the rule covers
    good: int

    def column(self, of: dict[str, Column]) -> Column:
        return _all_of(self.conditions, of)

    def __str__(self):
        tests = [f"{c.feature} {'>' if c.above else '<='} {c.edge:.6g}" for c in self.conditions]
        return f"reject if {' and '.join(tests)} ({self.bad} bad, {self.good} good)"


def _all_of(conditions, of):
    test = F.lit(True)
    for condition in conditions:
        test = test & condition.column(of)
    return test


def _edges_below(value, edges):
    return F.size(F.filter(F.array(*map(F.lit, edges)), lambda edge: edge < value))


def _best(rows, edges, names):
    """The condition with the highest gain in information, or None, and what it leaves."""
    counts = rows.select("bad", F.posexplode("bins").alias("feature", "bin")).groupBy("feature", "bin").agg(
        F.sum(F.col("bad").cast("long")).alias("bad"), F.count("*").alias("n")).collect()
    table = {}
    for row in counts:
        bad, good = table.setdefault(row["feature"], np.zeros((2, max(map(len, edges)) + 1)))
        bad[row["bin"]], good[row["bin"]] = row["bad"], row["n"] - row["bad"]
    best = (0.0, None, 0)
    for at in sorted(table):
        bad, good = table[at]
        all_bad, all_good = bad.sum(), good.sum()
        for k, edge in enumerate(edges[at]):
            for above in (False, True):
                p = bad[k + 1:].sum() if above else bad[:k + 1].sum()
                n = good[k + 1:].sum() if above else good[:k + 1].sum()
                if p:
                    gain = p * (math.log2(p / (p + n)) - math.log2(all_bad / (all_bad + all_good)))
                    if gain > best[0] + 1e-9:
                        best = (gain, Condition(names[at], above, edge), n)
    return best[1], best[2]


def learn(labelled: DataFrame, most_rules: int = 6, most_conditions: int = 4, edges_per_feature: int = 48,
          least_precision: float = 0.97, least_bad: int = 2) -> list[Rule]:
    """Rules that tell bad from good rows of ``labelled`` (doc_id, the counts, bad).

    All rows take part; a hash of the doc_id says which third is for pruning. Thresholds are approximate
    quantiles of the features. Learning ends when no further rule has ``least_precision`` and
    ``least_bad`` bad rows in the pruning part. No rows, or rows of one kind only, give no rule.
    """
    of = features()
    names = list(of)
    table = settled(labelled.where(F.col("bad").isNotNull()).select(
        "bad", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("pruning"),
        *[column.alias(name) for name, column in of.items()]), "rules-labelled")
    shares = [i / (edges_per_feature + 1) for i in range(1, edges_per_feature + 1)]
    edges = [sorted(set(found)) for found in table.approxQuantile(names, shares, 0.002)]
    if not all(edges):
        return []
    bins = F.array(*[_edges_below(F.col(name), cuts) for name, cuts in zip(names, edges)])
    table = settled(table.withColumn("bins", bins), "rules-bins")
    plain = {name: F.col(name) for name in names}
    rules, left = [], table
    while len(rules) < most_rules:
        conditions, rest = [], left.where(~F.col("pruning"))
        while len(conditions) < most_conditions:
            condition, good = _best(rest, edges, names)
            if condition is None or condition in conditions:
                break
            conditions.append(condition)
            rest = rest.where(condition.column(plain))
            if not good:
                break
        if not conditions:
            break
        # How many of the leading conditions each row of the pruning part fulfils.
        fulfilled = F.lit(0)
        for n in range(1, len(conditions) + 1):
            fulfilled = F.when(_all_of(conditions[:n], plain), n).otherwise(fulfilled)
        seen = {(row["n"], row["bad"]): row["count"] for row in left.where("pruning").groupBy(
            fulfilled.alias("n"), "bad").count().collect()}
        kept = []
        for n in range(1, len(conditions) + 1):
            bad = sum(c for (k, is_bad), c in seen.items() if k >= n and is_bad)
            good = sum(c for (k, is_bad), c in seen.items() if k >= n and not is_bad)
            if bad >= least_bad and bad >= least_precision * (bad + good):
                kept.append(((bad - good) / (bad + good), bad, -n, Rule(tuple(conditions[:n]), bad, good)))
        if not kept:
            break
        rules.append(max(kept, key=lambda k: k[:3])[3])
        left = left.where(~rules[-1].column(plain))
    return rules


def decision(rules: list[Rule]) -> Column:
    """The list as a conditional expression over the counts: true for rows that stay."""
    of = features()
    made = None
    for rule in rules:
        made = (F if made is None else made).when(rule.column(of), False)
    return F.lit(True) if made is None else made.otherwise(True)


def judge(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, text_key, the counts, base_failed, kept) for every row of ``docs`` (doc_id, text, any others).

    ``labels`` has (doc_id, quality); quality 0 is bad, the lower one counts if there are several, and
    null ones don't. Rules are learned from the labelled rows that the base rules pass. A null text
    counts as empty and fails, rows that repeat are judged alike, an empty table gives no rows.
    """
    counted = settled(statistics(docs).withColumn("base_failed", base_failed()), "rules-counts")
    quality = labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    labelled = counted.where(~F.col("base_failed")).join(quality, "doc_id").withColumn(
        "bad", F.col("quality") == 0)
    verdict = decision(learn(labelled, **options))
    return counted.withColumn("kept", ~F.col("base_failed") & verdict)


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, unchanged."""
    gone = judge(docs, labels, **options).where(~F.col("kept")).select("doc_id", "text_key").distinct()
    return same_row(docs, gone, "left_anti")
