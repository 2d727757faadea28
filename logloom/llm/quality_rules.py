"""Quality by weak supervision, in DataFrame functions alone.

Each rule looks at one statistic of a text and votes good (1) or bad (-1), or abstains (0). Expectation-maximisation
over the counted vote patterns estimates, for each rule, how often it is right on good and on bad documents, and
the share of good documents. A document's posterior probability of being good takes the place of "all rules must
pass"; an abstaining rule says nothing.

The patterns number at most 3 to the power of the rules, whatever the number of documents; an iteration is one
aggregate over them, and only its sums come to the driver. The statistics of a text are array functions on its own
row, so nothing is shuffled but pattern counts. Texts are read whole. The repeat count sorts window hashes and is
skipped for texts without a repeated window.

Null and empty texts have no words and fail the base check. Equal rows count each. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.storage import staged

SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 8
LEAST_WORDS = 20
REPEAT_PERCENT = 30
ITERATIONS = 12


@dataclass(frozen=True)
class Rule:
    """Votes bad where the statistic passes ``bad``, good where it passes ``good``; nulls abstain."""

    name: str
    statistic: Column
    bad: Callable[[Column], Column]
    good: Callable[[Column], Column]

    def vote(self) -> Column:
        return F.when(self.bad(self.statistic), -1).when(self.good(self.statistic), 1).otherwise(0).cast("tinyint")


def rules() -> list[Rule]:
    words = F.when(F.col("n_words") > 0, F.col("n_words"))
    lines = F.when(F.col("n_lines") > 1, F.col("n_lines"))
    return [
        Rule("symbols", F.col("n_symbols") / words, lambda x: x > 0.1, lambda x: x <= 0.02),
        Rule("repeated_windows", F.when(F.col("n_words") >= REPEAT_WINDOW, F.col("n_repeat_words") / words), lambda x: x > 0.2, lambda x: x < 0.05),
        Rule("adjacent_words", F.when(F.col("n_words") > 1, F.col("n_adjacent") / words), lambda x: x > 0.15, lambda x: x < 0.05),
        Rule("distinct_words", F.when(F.col("n_words").between(LEAST_WORDS, 2000), F.col("n_distinct") / words), lambda x: x < 0.35, lambda x: x > 0.5),
        Rule("repeated_lines", F.col("n_dup_lines") / lines, lambda x: x > 0.5, lambda x: x < 0.2),
        Rule("word_length", F.col("word_chars") / words, lambda x: (x < 2) | (x > 15), lambda x: x.between(3, 10)),
        Rule("letters", F.col("n_letters") / F.when(F.col("word_chars") > 0, F.col("word_chars")), lambda x: x < 0.75, lambda x: x > 0.85),
        Rule("mark_runs", F.col("n_runs") / words, lambda x: x > 0.05, lambda x: x < 0.01),
        Rule("bare_marks", F.col("n_bare") / words, lambda x: x > 0.1, lambda x: x < 0.02),
        Rule("length", F.col("n_words"), lambda x: x < 5, lambda x: x >= 40),
    ]


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once for the row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs more than once."""
    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def positions(s: Column) -> Column:
        same = lambda x, at: F.coalesce(F.get(s, at)["h"] == x["h"], F.lit(False))
        places = F.transform(s, lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["i"]))
        return F.sort_array(F.filter(places, lambda i: i.isNotNull()))

    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))
    step = lambda a, i: F.struct((a["total"] + i + REPEAT_WINDOW - F.greatest(a["end"], i)).alias("total"), (i + REPEAT_WINDOW).alias("end"))
    covered = F.aggregate(_bound(ordered, positions), start, step, lambda a: a["total"])
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), covered).otherwise(0)


def statistics(documents: DataFrame) -> DataFrame:
    """doc_id and the counts that the rules look at."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select("doc_id", text.alias("text"))
    words = F.filter(F.split("text", "[ \\t-\\r]+"), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike("[^ \\t-\\r]"))
    rows = rows.select("*", words.alias("words"), lines.alias("lines"), F.length(F.regexp_replace("text", "[ \\t-\\r]+", "")).alias("word_chars"))
    n = F.size("words")
    paired = lambda hashes, step: F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + step)))
    single = F.transform("words", lambda w: F.xxhash64(w))
    windows = _bound(single, lambda one: _bound(paired(one, 1), lambda two: _bound(paired(two, 2), lambda four: paired(four, 4))))
    hashes = F.when(n >= REPEAT_WINDOW, F.slice(windows, 1, n - REPEAT_WINDOW + 1)).otherwise(F.array().cast("array<long>"))
    adjacent = F.size(F.filter(F.transform("words", lambda w, i: w == F.get("words", i - 1)), lambda same: same))
    count = lambda pattern: F.regexp_count("text", F.lit(pattern))
    rows = rows.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        F.col("word_chars").cast("long").alias("word_chars"),
        count(f"[{SYMBOLS}]").cast("long").alias("n_symbols"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        adjacent.alias("n_adjacent"),
        count("([^\\p{L}\\p{N} \\t-\\r])\\1").alias("n_runs"),
        F.length(F.regexp_replace("text", "[^\\p{L}]+", "")).alias("n_letters"),
        count("(?<=[ \\t-\\r])[^\\p{L}\\p{N} \\t-\\r]+(?=[ \\t-\\r])").alias("n_bare"),
        hashes.alias("hashes"),
    )
    return rows.withColumn("n_repeat_words", _repeat_words(F.col("hashes")).cast("long")).drop("hashes")


@dataclass(frozen=True)
class LabelModel:
    """The share of good documents; for each rule, how often its vote is right on good and on bad ones."""

    prior: float
    right_good: list[float]
    right_bad: list[float]

    def posterior(self, votes: str = "votes") -> Column:
        log_odds = F.lit(0.0) + F.log(F.lit(self.prior / (1 - self.prior)))
        for k, (good, bad) in enumerate(zip(self.right_good, self.right_bad)):
            vote = F.get(votes, F.lit(k))
            log_odds = log_odds + F.when(vote == 1, F.log(F.lit(good / (1 - bad)))).when(vote == -1, F.log(F.lit((1 - good) / bad))).otherwise(0.0)
        return 1 / (1 + F.exp(-log_odds))


def fit(patterns: DataFrame, n_rules: int, iterations: int = ITERATIONS) -> LabelModel:
    """Expectation-maximisation over (votes, n).

    It starts from the belief that rules seldom accuse a good document and that each sees a part of the bad ones.
    """
    model = LabelModel(0.8, [0.98] * n_rules, [0.3] * n_rules)
    posterior = model.posterior()
    for _ in range(iterations):
        weight = F.col("n") * F.col("p")
        other = F.col("n") * (1 - F.col("p"))
        sums = [F.sum("n"), F.sum(weight)]
        for k in range(n_rules):
            vote = F.get("votes", F.lit(k))
            sums += [F.sum(F.when(vote == 1, weight)), F.sum(F.when(vote != 0, weight)), F.sum(F.when(vote == -1, other)), F.sum(F.when(vote != 0, other))]
        total, good, *rest = [x or 0.0 for x in patterns.withColumn("p", posterior).agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()]
        rate = lambda hits, n, belief: min(max((hits + 5 * belief) / (n + 5), 0.05), 0.995)
        model = LabelModel(
            min(max((good + 1) / (total + 2), 0.01), 0.99),
            [rate(rest[4 * k], rest[4 * k + 1], 0.98) for k in range(n_rules)],
            [rate(rest[4 * k + 2], rest[4 * k + 3], 0.3) for k in range(n_rules)],
        )
        posterior = model.posterior()
    return model


def judge(documents: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """Per row: doc_id, the counts, base_failed, votes, quality (posterior probability) and kept."""
    checks = rules()
    counted = statistics(documents)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    judged = staged(counted.select("*", failed.alias("base_failed"), F.array(*[r.vote() for r in checks]).alias("votes")))
    patterns = staged(judged.groupBy("votes").agg(F.count("*").alias("n")))
    model = fit(patterns, len(checks), iterations)
    return judged.withColumn("quality", model.posterior()).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))
