"""Quality rules on texts, and verdicts on the hosts that texts come from.

Every rule is a Spark expression on one text. Rule failures are then counted per
host, the rates are shrunk towards the rate of all hosts with a beta prior that is
fitted to them by moments, so that a host with few documents is not judged by them
alone, and the hosts' verdicts are joined back to the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmix.functions.frames import compute_once
from corpusmix.llm.common import WORD_BREAK_CLASS, fresh
from corpusmix.session import materialize

WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
MAX_HOST_RATE = 0.5
EVEN_EVIDENCE = 100
SYMBOLS = "[#*$%&|<>]"
RULES = ("short", "repetitive")


def _repeated(windows: str) -> str:
    """SQL for the windows whose hash another window has: their places in order, then the words they cover."""
    return f"""
aggregate(
  transform(
    array(sort_array(filter(flatten(transform(
      array(sort_array(transform(`{windows}`, (h, i) -> struct(h, i)))),
      s -> transform(s, (e, j) ->
        if(coalesce(get(s, j - 1).h = e.h, false) OR coalesce(get(s, j + 1).h = e.h, false), e.i, null))
    )), i -> i IS NOT NULL))),
    p -> aggregate(
      transform(p, (v, k) -> least({WINDOW_WORDS}, coalesce(get(p, k + 1) - v, {WINDOW_WORDS}))),
      0L, (a, b) -> a + b)
  ),
  0L, (a, b) -> a + b)
"""


def with_rules(docs: DataFrame, text: str = "text", into: str = "_rules") -> DataFrame:
    """Add a struct of counts and failures of each text; the rows stay where they are.

    A column called ``into`` is replaced, others of any name stay. Null text counts as empty. ``n_repeat_words``
    counts the words in windows of eight words that occur twice or more in the text.
    """
    words, lines, symbols, windows = (fresh(docs, name) for name in ("_words", "_lines", "_n_symbols", "_windows"))
    whole = F.coalesce(F.col(text), F.lit(""))
    split = compute_once(
        docs,
        **{
            words: F.array_remove(F.split(whole, f"{WORD_BREAK_CLASS}+"), ""),
            lines: F.filter(F.split(whole, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")),
            symbols: (F.size(F.split(whole, SYMBOLS)) - 1).cast("bigint"),
        },
    )
    starts = F.sequence(F.lit(1), F.size(words) - (WINDOW_WORDS - 1))
    hashes = F.when(
        F.size(words) > WINDOW_WORDS,
        F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, WINDOW_WORDS))),
    )
    hashed = compute_once(split, **{windows: hashes})
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    counted = compute_once(
        hashed,
        **{
            into: F.struct(
                F.size(words).cast("bigint").alias("n_words"),
                F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
                F.col(symbols).alias("n_symbols"),
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
                F.coalesce(F.when(repeats, F.expr(_repeated(windows))), F.lit(0)).cast("bigint").alias("n_repeat_words"),
            )
        },
    ).drop(words, lines, windows, symbols)
    count = F.col(into)
    short = count["n_words"] < MIN_WORDS
    repetitive = 100 * count["n_repeat_words"] > MAX_REPEATED_PERCENT * count["n_words"]
    return counted.withColumn(
        into,
        F.struct(
            f"{into}.*",
            short.alias("short"),
            repetitive.alias("repetitive"),
            (short | repetitive).alias("base_failed"),
        ),
    )


def host_verdicts(
    ruled: DataFrame, host: str = "source", rules: str = "_rules", max_rate: float = MAX_HOST_RATE
) -> DataFrame:
    """``host, documents, failed, rate, host_kept`` per host; a null host is one of its own.

    Rates are shrunk with a beta prior that is fitted to all hosts, see ``host_prior``. A host goes
    if its shrunk rate is above ``max_rate``.
    """
    failed = F.col(rules)["base_failed"]
    hosts = ruled.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("documents"),
        F.count_if(failed).alias("failed"),
        *[F.count_if(F.col(rules)[name]).alias(name) for name in RULES],
    )
    mean, weight = host_prior(hosts)
    if weight is None:
        rate = F.lit(mean).cast("double")
    else:
        rate = (F.col("failed") + F.lit(mean * weight)) / (F.col("documents") + F.lit(weight))
    judged = hosts.withColumn("rate", F.round(rate, 9))
    return judged.withColumn("host_kept", F.col("rate") <= max_rate)


def host_prior(hosts: DataFrame) -> tuple[float | None, float | None]:
    """Mean and weight of the beta prior of the hosts' failure rates, from ``documents, failed`` per host.

    The mean is that of all documents. What the rates of hosts differ by is partly chance, the more so the smaller the
    hosts: the size-weighted spread that chance alone gives is subtracted, and what is left over gives the
    share rho of the variance that lies between hosts, and the weight 1 / rho - 1. Few or small hosts say little
    about rho, so it is estimated as if ``EVEN_EVIDENCE`` further degrees of freedom had shown no difference. The
    weight is None, so that the mean stands for every host, where there is no more spread than by chance.
    """
    n, f = F.col("documents"), F.col("failed")
    # One line of five numbers.
    line = hosts.agg(
        F.count("*").alias("hosts"),
        F.sum(n).alias("n"),
        F.sum(f).alias("f"),
        F.sum(n * n.cast("double")).alias("squares"),
        F.sum(f * f.cast("double") / n).alias("weighted"),
    ).first()
    if not line["n"]:
        return None, None
    mean = line["f"] / line["n"]
    chance = mean * (1 - mean)
    spread = line["weighted"] - line["n"] * mean * mean - chance * (line["hosts"] - 1)
    freedom = line["n"] - line["squares"] / line["n"] - (line["hosts"] - 1) + EVEN_EVIDENCE
    if chance <= 0 or spread <= 0:
        return mean, None
    rho = spread / (chance * freedom)
    return mean, max(1 / rho - 1, 0.0)


def judge_ruled(
    rows: DataFrame,
    host: str = "source",
    max_rate: float = MAX_HOST_RATE,
    rules: str = "_rules",
    verdict: str = "_verdict",
) -> DataFrame:
    """Rows with a struct ``verdict`` in place of ``rules``: counts, failures, host rate, ``kept``.

    A column called ``verdict`` is replaced, others of any name stay; repeated rows are judged one by one.
    The rows are written once, so the rules run once; the hosts' lines are a small table
    of their own. An empty table gives an empty one.
    """
    ruled = materialize(rows, "quality_rules")
    key, rate, good = (fresh(ruled, name) for name in ("_host", "_rate", "_host_kept"))
    hosts = materialize(host_verdicts(ruled, host, rules, max_rate), "quality_hosts").select(
        F.col("host").alias(key), F.col("rate").alias(rate), F.col("host_kept").alias(good)
    )
    joined = ruled.join(hosts, F.col(host).eqNullSafe(F.col(key)), "left")
    kept = ~F.col(rules)["base_failed"] & F.coalesce(good, F.lit(True))
    judged = F.struct(f"{rules}.*", F.col(rate).alias("host_rate"), kept.alias("kept"))
    return joined.withColumn(verdict, judged).drop(rules, key, rate, good)


def keep_good(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass the rules and whose host does, with its columns, whatever their names.

    Null and empty texts fail the rules. Repeated rows stay or go together; an empty table gives an empty one.
    """
    rules, verdict = fresh(docs, "_rules"), fresh(docs, "_verdict")
    judged = judge_ruled(with_rules(docs, into=rules), host, rules=rules, verdict=verdict)
    return judged.where(F.col(verdict)["kept"]).select(*[F.col(f"`{c}`") for c in docs.columns])
