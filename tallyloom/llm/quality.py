"""Quality rules as weak supervision, in DataFrame functions only.

Each rule looks at one property of a text and votes good, votes bad or abstains. How far a vote
can be trusted is not set by hand: expectation-maximisation over the vote patterns of the whole
table estimates for either class how often each rule, when it votes, votes good or bad (a mixture
of two classes whose rules vote independently). An abstention is no evidence. The posterior
probability of the good class then decides, in place of "all rules must pass".

What reaches the driver are the counts of vote patterns, at most 3 to the number of rules,
whatever the size of the table.

Edge cases: a null text has no words; texts of fewer than ``LEAST_WORDS`` words fail the base
rules; repeated rows count as often as they occur; an empty table gives no rows and a model of
the starting rates. Only the named columns are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import WHITE_SPACE, free_prefix, shared_folder, words

LEAST_WORDS = 20
#: Of 100 words, so many may lie in repeated windows.
MOST_REPEATED = 30
WINDOW = 8
SYMBOL = r"[#*$%&|<>]"
GOOD, BAD, ABSTAINS = 1, 2, 0


def measure(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with the measures of each text, their names led by ``prefix``."""
    p = prefix
    keep = [F.col(c) for c in docs.columns]
    body = F.coalesce(F.col(text), F.lit(""))
    count = lambda c: c.cast("long")

    # Columns that a lambda refers to are made by a select of their own: written in place, they
    # would be computed again for each element.
    out = docs.select(*keep, words(F.col(text)).alias(f"{p}words"))
    keep = [F.col(c) for c in docs.columns]
    w = F.col(f"{p}words")
    lines = F.filter(F.split(body, "\n"), lambda x: F.length(F.btrim(x, F.lit(WHITE_SPACE))) > 0)
    letters = F.regexp_replace(body, r"[^\p{L}]+", "")
    out = out.select(
        *keep,
        count(F.size(w)).alias(f"{p}n_words"),
        F.transform(w, lambda x: F.xxhash64(x)).alias(f"{p}hashes"),
        count(F.length(F.concat_ws("", w))).alias(f"{p}word_chars"),
        count(F.regexp_count(body, F.lit(SYMBOL))).alias(f"{p}n_symbols"),
        lines.alias(f"{p}lines"),
        count(F.length(letters)).alias(f"{p}n_letters"),
        count(F.length(F.regexp_replace(letters, r"[^\p{Lu}]+", ""))).alias(f"{p}n_upper"),
        count(F.size(F.filter(w, lambda x: x.rlike(r"[.,;:!?]$")))).alias(f"{p}n_stops"),
        count(F.size(F.filter(w, lambda x: ~x.rlike(r"[\p{L}\p{N}]")))).alias(f"{p}n_bare"),
    )
    made = [f"{p}{c}" for c in ("n_words", "word_chars", "n_symbols", "n_letters", "n_upper", "n_stops", "n_bare")]
    h = F.col(f"{p}hashes")
    last = F.size(h) - WINDOW
    out = out.select(
        *keep,
        *made,
        count(F.size(f"{p}lines")).alias(f"{p}n_lines"),
        count(F.size(f"{p}lines") - F.size(F.array_distinct(f"{p}lines"))).alias(f"{p}n_dup_lines"),
        count(F.size(F.array_distinct(h))).alias(f"{p}n_distinct"),
        F.when(
            last >= 0,
            F.transform(
                F.sequence(F.lit(0), last),
                lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]),
            ),
        )
        .otherwise(F.array().cast("array<bigint>"))
        .alias(f"{p}windows"),
    )
    made += [f"{p}{c}" for c in ("n_lines", "n_dup_lines", "n_distinct")]
    v = F.col(f"{p}windows")
    # Most texts repeat no window; only for the others are the windows sorted.
    out = out.select(
        *keep,
        *made,
        F.when(
            F.size(F.array_distinct(v)) < F.size(v),
            F.sort_array(
                F.transform(v, lambda x, i: F.struct(x.alias("h"), i.alias("i"))),
            ),
        ).alias(f"{p}sorted"),
    )
    s = F.col(f"{p}sorted")

    def repeated(e: Column, k: Column) -> Column:
        same = lambda j: F.coalesce(F.get(s, j)["h"] == e["h"], F.lit(False))
        return same(k - 1) | same(k + 1)

    begins = F.sort_array(F.transform(F.filter(s, repeated), lambda e: e["i"]))
    covered = F.aggregate(
        begins,
        F.struct(F.lit(-WINDOW).alias("before"), F.lit(0).alias("n")),
        lambda acc, x: F.struct(
            x.alias("before"),
            (acc["n"] + F.least(F.lit(WINDOW), x - acc["before"])).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    return out.select(
        *keep,
        *made,
        count(F.when(s.isNull(), 0).otherwise(covered)).alias(f"{p}n_repeat_words"),
    )


def base_failed(p: str = "") -> Column:
    n = F.col(f"{p}n_words")
    return (n < LEAST_WORDS) | (100 * F.col(f"{p}n_repeat_words") > MOST_REPEATED * n)


def votes(p: str = "") -> dict[str, Column]:
    """Each rule's vote. A rule with too little to go by abstains."""
    n = F.greatest(F.col(f"{p}n_words"), F.lit(1)).cast("double")
    lines = F.greatest(F.col(f"{p}n_lines"), F.lit(1)).cast("double")
    letters = F.greatest(F.col(f"{p}n_letters"), F.lit(1)).cast("double")
    chars = F.greatest(F.col(f"{p}word_chars"), F.lit(1)).cast("double")
    share = lambda c, of: F.col(f"{p}{c}") / of

    def rule(x: Column, good: float, bad: float, least: Column | None = None) -> Column:
        """Good up to ``good``, bad from ``bad`` on (or the other way round)."""
        up = bad > good
        vote = (
            F.when((x <= good) if up else (x >= good), GOOD)
            .when((x >= bad) if up else (x <= bad), BAD)
            .otherwise(ABSTAINS)
        )
        return vote if least is None else F.when(least, vote).otherwise(ABSTAINS)

    long_enough = F.col(f"{p}n_words") >= 2 * LEAST_WORDS
    return {
        "length": rule(F.col(f"{p}n_words").cast("double"), 1.5 * LEAST_WORDS, LEAST_WORDS - 1.0),
        "word_length": rule(F.abs(share("word_chars", n) - 5.5), 2.5, 5.0),
        "symbols": rule(share("n_symbols", n), 0.02, 0.1),
        "bare": rule(share("n_bare", n), 0.05, 0.15),
        "letters": rule(share("n_letters", chars), 0.85, 0.7),
        "capitals": rule(share("n_upper", letters), 0.15, 0.3),
        "stops": rule(share("n_stops", n), 0.05, 0.02, long_enough),
        "lines": rule(share("n_dup_lines", lines), 0.3, 0.5, F.col(f"{p}n_lines") >= 4),
        "windows": rule(share("n_repeat_words", n), 0.1, 0.25, long_enough),
        "distinct": rule(
            share("n_distinct", F.sqrt(n)), 3.0, 1.5, long_enough
        ),  # distinct words grow about as the root of all
    }


@dataclass(frozen=True)
class Model:
    """Prior of the good class, and for each rule the log odds (good to bad) of either vote."""

    prior: float
    odds: dict[str, tuple[float, float]]

    def log_odds(self, p: str = "") -> Column:
        total: Column = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, vote in votes(p).items():
            good, bad = (float(x) for x in self.odds[name])
            total = total + F.when(vote == GOOD, good).when(vote == BAD, bad).otherwise(0.0)
        return total


def fit(measured: DataFrame, p: str = "", rounds: int = 200) -> Model:
    """Expectation-maximisation over the counts of vote patterns.

    Starting rates say that a rule is right more often than wrong; they stay as pseudo-counts
    (``strength`` texts in a hundred), which keeps the two classes from changing places and rates
    from reaching 0. All sums run over sorted patterns, so reruns agree to the last bit.
    """
    rules = votes(p)
    found = (
        measured.groupBy(*[v.alias(k) for k, v in rules.items()])
        .agg(F.count("*").alias("texts"))
        .collect()
    )
    found = sorted(tuple(r) for r in found)
    pattern = np.array([r[:-1] for r in found], dtype=int).reshape(len(found), len(rules))
    texts = np.array([r[-1] for r in found], dtype=float)
    # start[c]: how often a rule that votes on class c (bad, good) votes bad
    start = np.array([0.4, 0.02])
    strength = max(1.0, 0.01 * texts.sum())
    rates = np.repeat(start[:, None], len(rules), axis=1)
    prior = 0.8
    is_bad, is_good = ((pattern == v).astype(float) for v in (BAD, GOOD))
    for _ in range(rounds):
        log = np.log(rates) @ is_bad.T + np.log(1 - rates) @ is_good.T
        log += np.log([[1 - prior], [prior]])
        good = 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))
        weight = np.stack([texts * (1 - good), texts * good])
        prior = (weight[1].sum() + 0.8 * strength) / (weight.sum() + strength)
        bad_votes = weight @ is_bad + strength * start[:, None]
        rates = bad_votes / (weight @ (is_bad + is_good) + strength)
    odds = np.stack([np.log((1 - rates[1]) / (1 - rates[0])), np.log(rates[1] / rates[0])])
    return Model(float(prior), {k: tuple(odds[:, i].tolist()) for i, k in enumerate(rules)})


def judged(measured: DataFrame, model: Model, p: str = "") -> DataFrame:
    """Measured rows with ``base_failed``, ``quality`` (the posterior) and ``kept``."""
    log_odds = model.log_odds(p)
    failed = base_failed(p)
    return measured.withColumns(
        {
            f"{p}base_failed": failed,
            f"{p}quality": F.round(1 / (1 + F.exp(-log_odds)), 6),
            f"{p}kept": ~failed & (log_odds >= 0),
        }
    )


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that are kept, in their own columns. No shuffle but of the pattern counts.

    The measures are taken once: the rows are written with them to the shared folder, the model is
    fitted on the measures alone, and the verdicts read them.
    """
    spark, p = docs.sparkSession, free_prefix(docs.columns)
    path = shared_folder(spark, "measured")
    measure(docs, text, p).write.option("compression", "zstd").parquet(path)
    measured = spark.read.parquet(path)
    model = fit(measured, p)
    return judged(measured, model, p).where(f"{p}kept").select(*docs.columns)
