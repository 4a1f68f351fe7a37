"""Quality rules as weak supervision: rules vote or abstain, their accuracies are estimated, a posterior decides.

Native: every text statistic, vote and posterior is a Column. Rules vote 1 (clean), -1 (junk) or 0 (abstain). The rows are
counted by vote pattern, of which there are at most 3 to the number of rules, and expectation-maximisation on these
counts estimates for each rule how often it votes each way on clean and on junk documents, and the share of junk. A
document's posterior probability of being clean follows from its votes; no rule has to pass alone.

With two unlabelled classes the likelihood also has optima at which one kind of junk is a class and the rest counts as noise
among clean documents. A prior on false alarms keeps away from these: ``PRIOR`` times the number of documents speak for
``FALSE_ALARM`` votes against clean documents. It is a share of the rows, so it acts alike at every size.

Null texts count as empty: no words, so they fail the base rules. Long texts are counted whole, ties do not arise,
rows that repeat are judged each for itself, and an empty table gives no rows. Extra columns of any name stay.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpscope.llm.common import written

SPACE = r"[\x20\x09-\x0D]+"
THRESHOLD = 0.5
FALSE_ALARM = 0.002
PRIOR = 20.0
ROUNDS = 60
#: Rejected keys up to this many are broadcast, 16 bytes each; beyond, the join is shuffled.
BROADCAST_ROWS = 1_000_000

#: Statistic by which each rule votes, junk condition, clean condition; in between the rule abstains.
RULES: dict[str, tuple[str, str]] = {
    "length": ("n_words < 50", "n_words >= 100"),
    "word_length": ("word_chars < 2 * n_words OR word_chars > 14 * n_words", "word_chars BETWEEN 3 * n_words AND 10 * n_words"),
    "symbols": ("10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    "capitals": ("100 * n_capitals > 30 * word_chars", "100 * n_capitals <= 12 * word_chars"),
    "repeated_lines": ("100 * n_dup_lines > 60 * n_lines", "n_dup_lines = 0"),
    "repeated_words": ("100 * n_repeat_words > 45 * n_words", "100 * n_repeat_words <= 10 * n_words"),
    "variety": ("ln(n_distinct) < 0.77 * ln(n_words)", "ln(n_distinct) >= 0.82 * ln(n_words)"),
}
VOTES = tuple(RULES)


def _covered(flagged: Column) -> Column:
    """Words inside the three-word windows at the given ascending positions."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("stop"))
    step = lambda acc, p: F.struct((acc["n"] + p + 3 - F.greatest(p, acc["stop"])).alias("n"), (p + 3).alias("stop"))
    return F.aggregate(flagged, zero, step, lambda acc: acc["n"])


def statistics(docs: DataFrame) -> DataFrame:
    """``row`` (the given row) and ``stats``, a struct of long statistics of the whole text."""
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    df = df.withColumn("text", F.coalesce(F.col("row.text"), F.lit("")))
    df = df.withColumn("words", F.array_remove(F.split("text", SPACE), ""))
    df = df.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    n = F.size("words")
    few = F.greatest(n - 2, F.lit(0))
    pairs = F.zip_with(F.slice("words", 1, few), F.slice("words", 2, few), lambda a, b: F.xxhash64(a, b))
    triples = F.zip_with(pairs, F.slice("words", 3, few), lambda a, b: F.xxhash64(a, b))
    df = df.withColumn("triples", F.when(n > 3, triples).otherwise(F.array().cast("array<bigint>")))
    placed = F.sort_array(F.transform("triples", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct("triples")) < F.size("triples")
    df = df.withColumn("placed", F.when(repeats, placed).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    again = F.filter(
        "placed",
        lambda x, i: F.coalesce(F.get("placed", i - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get("placed", i + 1)["h"] == x["h"], F.lit(False)),
    )
    counted = {
        "n_words": n,
        "word_chars": F.length(F.array_join("words", "")),
        "n_symbols": F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]", "")),
        "n_capitals": F.length("text") - F.length(F.regexp_replace("text", r"\p{Lu}", "")),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": _covered(F.sort_array(F.transform(again, lambda x: x["i"]))),
        "n_distinct": F.size(F.array_distinct("words")),
    }
    return df.select("row", F.struct(*[c.cast("long").alias(name) for name, c in counted.items()]).alias("stats"))


def vote(rule: str) -> Column:
    """1, -1 or 0, from columns named as the statistics."""
    junk, clean = RULES[rule]
    return F.expr(f"CASE WHEN n_words = 0 THEN 0 WHEN {junk} THEN -1 WHEN {clean} THEN 1 ELSE 0 END")


def estimate(patterns: Mapping[tuple[int, ...], int]) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """Share of junk, and for each rule the probability of each vote on clean and on junk documents, when it votes.

    ``patterns`` has the number of documents for each tuple of votes. An abstention is no evidence. The start takes the
    rules at their word: any vote against makes junk likely.
    """
    total = sum(patterns.values())
    rules = len(next(iter(patterns), VOTES))
    junk_of = {p: 0.95 if -1 in p else 0.02 for p in patterns}
    share, tables = 0.1, [{-1: (0.5, 0.5), 1: (0.5, 0.5)} for _ in range(rules)]
    for _ in range(ROUNDS if total else 0):
        junk = sum(n * junk_of[p] for p, n in patterns.items())
        share = (junk + 1) / (total + 2)
        weight = PRIOR * total + 1
        for j, table in enumerate(tables):
            count = {-1: [0.0, 0.0], 0: [0.0, 0.0], 1: [0.0, 0.0]}
            for p, n in patterns.items():
                count[p[j]][0] += n * (1 - junk_of[p])
                count[p[j]][1] += n * junk_of[p]
            alarm = (count[-1][0] + weight * FALSE_ALARM) / (count[-1][0] + count[1][0] + weight)
            caught = (count[-1][1] + 1) / (count[-1][1] + count[1][1] + 2)
            table.update({-1: (alarm, caught), 1: (1 - alarm, 1 - caught)})
        for p in patterns:
            votes = [t[v][1] / t[v][0] for t, v in zip(tables, p, strict=True) if v]
            odds = math.log(share / (1 - share)) + sum(map(math.log, votes))
            junk_of[p] = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
    return share, tables


def fit(stats: DataFrame) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """Estimate from a table with the statistics as columns. Only counts by vote pattern reach the driver."""
    votes = stats.select(*[vote(r).alias(r) for r in VOTES])
    rows = votes.groupBy(*VOTES).count().collect()
    return estimate({tuple(r[v] for v in VOTES): r["count"] for r in rows})


def posterior(model: tuple[float, list[dict[int, tuple[float, float]]]]) -> Column:
    """Probability that a document is clean, from columns named as the statistics."""
    share, tables = model
    odds = F.lit(math.log((1 - share) / share))
    for rule, table in zip(VOTES, tables, strict=True):
        weight = {v: math.log(clean / junk) for v, (clean, junk) in table.items()}
        v = vote(rule)
        odds += F.when(v == -1, weight[-1]).when(v == 1, weight[1]).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def base_failed() -> Column:
    return F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")


def judge(docs: DataFrame) -> DataFrame:
    """A row for each document: key, statistics, ``base_failed``, ``p_clean`` and ``kept``."""
    stats = written(statistics(docs).select("row.doc_id", "stats.*"), "rules")
    p = posterior(fit(stats))
    out = stats.withColumns({"base_failed": base_failed(), "p_clean": p})
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("p_clean") >= THRESHOLD))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, all columns as given.

    The verdicts come from the written statistics, by key and hash of the text: a filter on the statistics themselves
    would be moved below them and compute lists anew for each of their elements.
    """
    text = F.xxhash64(F.coalesce("row.text", F.lit("")))
    stats = written(statistics(docs).select(F.col("row.doc_id").alias("rejected_id"), text.alias("rejected_text"), "stats.*"), "rules")
    good = ~base_failed() & (posterior(fit(stats)) >= THRESHOLD)
    rejected = written(stats.filter(~good).select("rejected_id", "rejected_text").distinct(), "rejected")
    if rejected.count() <= BROADCAST_ROWS:
        rejected = F.broadcast(rejected)
    same = docs["doc_id"].eqNullSafe(rejected["rejected_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == rejected["rejected_text"])
    return docs.join(rejected, same, "left_anti")
