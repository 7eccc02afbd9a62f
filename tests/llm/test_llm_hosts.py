"""The prior of host failure rates: tables on which hosts decide, and maximum likelihood beside the moments."""

import math
import random

import numpy as np
import pytest

from corpusmix.llm import quality

GOOD = " ".join(f"word{n}" for n in range(40))
BAD = "too short"


def docs_of(spark, hosts):
    """``hosts``: name, good documents, bad documents."""
    rows = [(name, text) for name, good, bad in hosts for text in [GOOD] * good + [BAD] * bad]
    return spark.createDataFrame([(k, text, name) for k, (name, text) in enumerate(rows)], "doc_id long, text string, source string")


def log_likelihood(mean, weight, counts):
    a, b = mean * weight, (1 - mean) * weight
    beta = lambda x, y: math.lgamma(x) + math.lgamma(y) - math.lgamma(x + y)
    return sum(beta(f + a, n - f + b) - beta(a, b) for n, f in counts)


def prior_of(spark, counts):
    return quality.host_prior(spark.createDataFrame(counts, "documents long, failed long"))


@pytest.mark.parametrize("alpha,beta", [(2, 8), (0.5, 4.5), (20, 80)])
def test_moments_are_near_the_maximum_likelihood(spark, alpha, beta):
    rng = np.random.default_rng(int(alpha * 10))
    sizes = rng.integers(5, 80, 1500)
    counts = [(int(n), int(rng.binomial(n, p))) for n, p in zip(sizes, rng.beta(alpha, beta, len(sizes)))]
    mean, weight = prior_of(spark, counts)
    weights = np.geomspace(0.5, 1000, 60)
    best = max(weights, key=lambda w: log_likelihood(mean, w, counts))
    assert abs(mean - alpha / (alpha + beta)) < 0.02
    assert 0.7 * best < weight < 1.4 * best and 0.7 * (alpha + beta) < weight < 1.4 * (alpha + beta)


def test_a_small_host_among_many_small_ones_is_not_judged_by_its_own_rate(spark):
    """A thousand hosts of one document, one in ten of them bad, and one of three with two bad ones."""
    hosts = [(f"h{n}", int(n % 10 > 0), int(n % 10 == 0)) for n in range(1000)] + [("three", 1, 2)]
    kept = quality.keep_good(docs_of(spark, hosts))
    assert kept.count() == 901 and kept.where("source = 'three'").count() == 1


def test_large_bad_hosts_go_with_their_good_documents(spark):
    hosts = [(f"h{n}", 40, 2) for n in range(20)] + [("bad", 30, 60), (None, 3, 40), ("tiny", 1, 1)]
    docs = docs_of(spark, hosts)
    kept = {r["source"]: r["count"] for r in quality.keep_good(docs).groupBy("source").count().collect()}
    assert "bad" not in kept and None not in kept and kept["tiny"] == 1 and kept["h0"] == 40
    judged = quality.host_verdicts(quality.with_rules(docs)).collect()
    assert sorted((r["host"], r["host_kept"]) for r in judged if r["host"] in ("bad", "tiny")) == [("bad", False), ("tiny", True)]


def test_hosts_without_spread_have_the_mean(spark):
    assert prior_of(spark, [(10, 1)] * 30) == (0.1, None)
    assert prior_of(spark, [(10, 0)] * 3) == (0.0, None)
    assert prior_of(spark, [(4, 4), (9, 9)]) == (1.0, None)
    assert prior_of(spark, [(5, 2)]) == (0.4, None)
    assert quality.host_prior(spark.createDataFrame([], "documents long, failed long")) == (None, None)
    rng = random.Random(1)
    mean, weight = prior_of(spark, [(n, n * (k % 2)) for k, n in ((k, rng.randrange(500, 900)) for k in range(40))])
    assert weight < 0.1 and 0.4 < mean < 0.6
