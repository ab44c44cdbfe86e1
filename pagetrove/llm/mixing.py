"""Mixing sources to target weights by soft membership.

A classifier learned from a labelled table says how likely each document belongs to each domain. Rates of
the documents, zero or more, are then fitted so that the expected tokens of the domains match the
targets: least squares by projected gradient. A gradient step adds to a document's rate a multiple of
its posteriors, and the projection lifts it to the least rate, so a rate is a function of the posteriors
and of the steps so far; each step is one aggregation over the written posteriors, and the driver
keeps a few numbers per step.

Only DataFrame functions are used. The classifier is a naive Bayes over hashed words (runs of letters),
whose table has a fixed number of rows.
"""

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetrove.llm.common import same_row
from pagetrove.session import settled

LETTERS = r"(\p{L}+)"  # what counts as a word here
BUCKETS = 4096
STEPS = 24  # between two looks at whether they help
TOLERANCE = 1e-4  # relative distance from the targets at which fitting ends
DOMAINS = 32  # at most


def _buckets(text: str = "text") -> Column:
    """The buckets of a text's lower-cased words, one row each; a single null for a text without any."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(LETTERS))
    return F.explode_outer(words)


def _words(docs: DataFrame, *keep: str) -> DataFrame:
    bucket = F.when(F.col("word").isNotNull(), F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).cast("int"))
    return docs.select(*keep, _buckets().alias("word")).select(*keep, bucket.alias("bucket"))


def fit_classifier(labelled: DataFrame) -> tuple[list[str], list[float], DataFrame]:
    """(domains, log priors, table of buckets with one log likelihood per domain) from ``labelled``
    (text, domain). Rows with a null domain don't count. All labelled rows are counted."""
    labelled = labelled.where(F.col("domain").isNotNull()).withColumn("domain", F.col("domain").cast("string"))
    sizes = {r["domain"]: r["count"] for r in labelled.groupBy("domain").count().orderBy("domain").take(DOMAINS + 1)}
    if len(sizes) > DOMAINS:
        raise ValueError(f"more than {DOMAINS} domains")
    domains = sorted(sizes)
    words = _words(labelled, "domain").where(F.col("bucket").isNotNull())
    counts = settled(words.groupBy("bucket", "domain").agg(
        F.count("*").alias("n")), "mixing-counts")
    totals = {r["domain"]: r["n"] for r in counts.groupBy("domain").agg(F.sum("n").alias("n")).collect()}
    per_domain = [
        F.log((F.coalesce(F.sum(F.when(F.col("domain") == d, F.col("n"))), F.lit(0)) + 1.0)
              / (totals.get(d, 0) + BUCKETS)).alias(f"log_{i}")
        for i, d in enumerate(domains)]
    # Every bucket has a row, seen or not.
    buckets = labelled.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    table = buckets.join(counts, "bucket", "left").groupBy("bucket").agg(
        *(per_domain or [F.lit(0.0).alias("log_0")]))
    rows = sum(sizes.values())
    return domains, [math.log(sizes[d] / rows) for d in domains], settled(table, "mixing-table")


def posteriors(docs: DataFrame, domains: list[str], priors: list[float], table: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_tokens, p) for every row of ``docs``, p with one entry per domain.
    ``n_tokens`` counts words. A text without words has the priors for posteriors."""
    # The number of a row keeps repeated rows apart until their words are summed up.
    row = ("doc_id", "text_key", "row")
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text",
                        F.monotonically_increasing_id().alias("row"))
    words = _words(keyed, *row).join(F.broadcast(table), "bucket", "left")  # BUCKETS rows
    logs = F.array(*[F.coalesce(F.sum(f"log_{i}"), F.lit(0.0)) + prior for i, prior in enumerate(priors)])
    sums = words.groupBy(*row).agg(F.count("bucket").alias("n_tokens"), logs.alias("logs"))
    chances = sums.withColumn("p", F.transform("logs", lambda x: F.exp(x - F.array_max("logs"))))
    share = F.aggregate("p", F.lit(0.0), lambda a, x: a + x)
    return chances.select("doc_id", "text_key", "n_tokens", F.transform("p", lambda x: x / share).alias("p"))


def rate(steps: list[list[float]], least: float, start: Column | None = None) -> Column:
    """The rate of a document after the gradient steps: from ``start``, or 1, each step takes off its weights
    times the posteriors ``p`` and is projected to rates of at least ``least``."""

    def stepped(value, weights):
        taken = reduce(lambda a, b: a + b, [F.lit(w) * F.col("p")[i] for i, w in enumerate(weights)])
        return F.greatest(F.lit(least), value - taken)

    return reduce(stepped, steps, F.lit(max(1.0, least)) if start is None else start)


def _expected(members, rates, many):
    """Expected tokens of every domain."""
    sums = members.agg(*[F.sum(F.col("n_tokens") * rates * F.col("p")[i]).alias(f"d{i}") for i in range(many)]).first()
    return [sums[i] or 0.0 for i in range(many)]


@dataclass
class _Goal:
    """What the domains' expected tokens are to be, of ``budget`` in all; ``there`` are the domains that can be
    matched, ``scale`` their tokens at the start."""

    wanted: list[float]
    there: list[int]
    scale: list[float]
    budget: float

    def residual(self, now):
        """Greatest distance of a domain from its tokens, as a share of the budget."""
        return max(abs(now[i] - self.wanted[i]) for i in self.there) / self.budget


def _goal(now, targets, least, budget):
    # Below a token, a domain is not there: its share could only be met by rates without bound.
    there = [i for i, tokens in enumerate(now) if tokens >= 1.0 and targets[i] > 0]
    if not there:
        return None
    total = sum(targets[i] for i in there)
    shares = [target / total if i in there else 0.0 for i, target in enumerate(targets)]
    if budget is None:
        budget = sum(now)
        if least > 0:
            budget = max(budget, *[now[i] / shares[i] for i in there])
    return _Goal([share * budget for share in shares], there, list(now), budget)


def _descend(members, now, goal, least, start=None):
    """(at most ``STEPS`` gradient steps, expected tokens after them)."""
    steps: list[list[float]] = []
    while len(steps) < STEPS and goal.residual(now) > TOLERANCE:
        # Tokens of a domain change by its mass times the step, whatever the rates are now.
        steps.append([(tokens - wanted) / max(scale, 1.0) if scale >= 1.0 else 0.0
                      for tokens, wanted, scale in zip(now, goal.wanted, goal.scale)])
        now = _expected(members, rate(steps, least, start), len(now))
    return steps, now


def fit_rates(members: DataFrame, targets: list[float], least: float = 0.0,
              budget: float | None = None) -> list[list[float]]:
    """At most ``STEPS`` gradient steps that bring the domains' expected tokens to the shares ``targets``.

    ``members`` is a written table (n_tokens, p). ``budget`` is the number of tokens to end with; without
    it as many as there are, or as many as it takes if no rate may fall below ``least``. Each domain's
    residual is measured against its present tokens, a diagonal scaling of the gradient. Domains
    without expected tokens cannot be matched and are left alone.
    """
    now = _expected(members, rate([], least), len(targets))
    goal = _goal(now, targets, least, budget)
    return _descend(members, now, goal, least)[0] if goal else []


def rated(members: DataFrame, targets: list[float], least: float = 0.0,
          budget: float | None = None) -> tuple[DataFrame, float, bool]:
    """(``members`` with ``rate``, residual, whether the targets are met): the steps of ``fit_rates``, for as long as
    they help.

    After every ``STEPS`` steps the rates are written and the next steps start from them, so that no expression
    grows with their number. It ends when every domain is within ``TOLERANCE`` of its tokens, as a share of
    the budget, or when ``STEPS`` steps take less than a tenth off the greatest distance, the residual: then the
    targets are out of reach, as they are if a wanted domain has no expected tokens.
    """
    now = _expected(members, rate([], least), len(targets))
    goal = _goal(now, targets, least, budget)
    if goal is None:
        return members.withColumn("rate", rate([], least)), 0.0, not any(targets)
    start = None
    while True:
        before = goal.residual(now)
        steps, now = _descend(members, now, goal, least, start)
        after = members.withColumn("rate", rate(steps, least, start))
        left = goal.residual(now)
        if left <= TOLERANCE or left > 0.9 * before:
            met = left <= TOLERANCE and len(goal.there) == sum(target > 0 for target in targets)
            return after, left, met
        members, start = settled(after, "mixing-rates"), F.col("rate")


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | Callable[[dict[str, float]], dict[str, float]],
        least: float = 0.0, budget: float | None = None, strict: bool = False) -> DataFrame:
    """(doc_id, text_key, n_tokens, domains, posteriors, rate, copies, residual, converged) for every row of
    ``docs`` (doc_id, text, any others).

    ``labelled`` has (text, domain); ``targets`` are weights by domain, domains that it lacks are not wanted, or a
    function that gives them for the expected tokens of the domains in all of ``docs``.
    ``copies`` is how often to take the row: the rate rounded down or up, at random by a hash of the
    document, so that the sum comes out as fitted. ``converged`` says in every row whether the targets are met, and
    ``residual`` how far, as a share of all tokens, the worst domain is from its target; with ``strict`` targets out of
    reach are an error. A null text is blank: no tokens, and the priors for
    posteriors. Rows that repeat have the same posteriors and rate. Without labelled rows every rate is 1.
    An empty table gives no rows.
    """
    domains, priors, table = fit_classifier(labelled)
    # Without a labelled row there is one nameless domain, which everything belongs to.
    members = settled(posteriors(docs, domains, priors or [0.0], table), "mixing-members")
    if callable(targets):
        targets = targets(dict(zip(domains, _expected(members, F.lit(1.0), len(domains)))) if domains else {})
    weights = [float(targets.get(domain, 0.0)) for domain in domains]
    if domains:
        found, residual, converged = rated(members, weights, least, budget)
    else:
        found, residual, converged = members.withColumn("rate", rate([], least)), 0.0, not any(targets.values())
    if strict and not converged:
        raise ValueError(f"the targets are out of reach: a domain stays {residual:.2g} of all tokens from its own")
    chance = F.pmod(F.xxhash64("doc_id", "text_key", F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)
    return found.select(
        "doc_id", "text_key", "n_tokens", F.array(*map(F.lit, domains)).cast("array<string>").alias("domains"),
        F.col("p").alias("posteriors"), "rate",
        F.floor(F.col("rate") + chance).cast("long").alias("copies"),
        F.lit(residual).alias("residual"), F.lit(converged).alias("converged"))


def repeat_rows(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as ``mixed`` says."""
    copies = mixed.groupBy("doc_id", "text_key").agg(F.max("copies").alias("__copies")).where("__copies > 0")
    found = same_row(docs, copies, "inner")
    return found.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies"))).drop(
        "__copies", "__copy")
