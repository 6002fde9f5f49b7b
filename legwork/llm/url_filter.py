"""URL verdicts: listed rules first, gradient-boosted trees on lexical features for the rest.

The trees are trained on the URLs that rules decide. Features are read off the URL alone:
lengths, depth, digit ratio, character entropy, counts of parameters and marks, and the smoothed
block rate of the host's suffixes among the labelled URLs. Fitting and scoring are MLlib.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legwork.llm.quality import bound
from legwork.llm.text import ascii_lower, filled, shielded, sized_broadcast, unshielded
from legwork.session import cut_to_table


class SiteRule(NamedTuple):
    """Fits the host and all its subdomains where the URL's path starts with ``path``."""

    host: str
    path: str
    verdict: str


# The rules the query applies.
RULES = (
    SiteRule("org", "/", "allow"),
    SiteRule("example.org", "/es/", "block"),
    SiteRule("example.org", "/en/1", "block"),
    SiteRule("com", "/fr/", "allow"),
    SiteRule("com", "/de/", "block"),
)
#: Most labelled URLs that the trees are fitted on, drawn by hash; suffix rates use all.
FIT_ROWS = 20_000
#: Weight of the overall block rate in a suffix's rate.
PRIOR_ROWS = 20.0
#: Parts of the labelled rows whose rates leave themselves out.
FOLDS = 5
FEATURES = (
    "url_length", "host_length", "path_length", "query_length", "depth", "host_labels", "digit_ratio",
    "host_digits", "entropy", "parameters", "hyphens", "longest_part", "has_fragment", "last_part_dots",
    "suffix_rate", "site_rate",
)


def host_and_path(url: Column | str) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty for null and for URLs without ``://``."""
    text = filled(url)
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[SiteRule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null if none does.

    Length is that of host and path together; among equally long ones the longer host, then
    the smaller text wins. The rules are settings and become part of the plan.
    """
    ordered = sorted(rules, key=lambda r: (-len(r.host + r.path), -len(r.host), r))
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in reversed(ordered):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


def entropy(text: Column) -> Column:
    """Bits per character; counts of a character come from taking it out of the text."""

    def of(chars: Column) -> Column:
        total = F.length(text)

        def add(sum_: Column, c: Column) -> Column:
            share = (total - F.length(F.replace(text, c, F.lit("")))) / total
            return sum_ - share * F.log2(share)

        return F.aggregate(F.filter(F.array_distinct(chars), lambda c: c != ""), F.lit(0.0), add)

    return F.when(F.length(text) > 0, bound(F.split(text, ""), of)).otherwise(0.0)


def count_of(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def lexical(pages: DataFrame, url_col: str, rules: Sequence[SiteRule]) -> DataFrame:
    """``pages`` with host, path, match, suffixes and the features but the suffix rates."""
    host, path = host_and_path(url_col)
    url = filled(url_col)
    base = pages.select("*", F.inline_outer(F.array(F.struct(host.alias("_u_host"), path.alias("_u_path")))))
    host, path = F.col("_u_host"), F.col("_u_path")
    labels, parts = F.split(host, r"\."), F.split(path, "/")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    features = {
        "url_length": F.length(url), "host_length": F.length(host), "path_length": F.length(path),
        "query_length": F.length(query), "depth": count_of(path, "/"), "host_labels": F.size(labels),
        "digit_ratio": count_of(url, "[0-9]") / F.greatest(F.length(url), F.lit(1)),
        "host_digits": count_of(host, "[0-9]"), "entropy": entropy(url),
        "parameters": F.when(query == "", 0).otherwise(count_of(query, "&") + 1),
        "hyphens": count_of(host, "-"),
        "longest_part": F.aggregate(parts, F.lit(0), lambda m, p: F.greatest(m, F.length(p))),
        "has_fragment": F.contains(url, F.lit("#")).cast("int"),
        "last_part_dots": count_of(F.element_at(parts, -1), r"\."),
    }
    suffix = F.element_at(labels, -1)
    site = F.when(F.size(labels) > 1, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(host)
    return base.withColumns(
        {f"_u_{name}": value.cast("double") for name, value in features.items()}
        | {"_u_match": matching_rule(host, path, rules), "_u_suffix": suffix, "_u_site": site}
    )


def block_counts(labelled: DataFrame, key: str, folds: bool) -> DataFrame:
    """Labelled rows and blocked ones per ``key``; with ``folds`` per fold those outside of it."""
    blocked, rows = F.sum("label").alias("_u_blocked"), F.count(F.lit(1)).alias("_u_rows")
    if not folds:
        return labelled.groupBy(key).agg(blocked, rows)
    inside = labelled.groupBy(key, "_u_fold").agg(blocked, rows)
    whole = Window.partitionBy(key)  # FOLDS rows at most
    return inside.select(
        key, "_u_fold", *[(F.sum(c).over(whole) - F.col(c)).alias(c) for c in ("_u_blocked", "_u_rows")]
    )


def with_rates(frame: DataFrame, labelled: DataFrame, mean: float, folds: bool = False) -> DataFrame:
    """Adds ``_u_suffix_rate`` and ``_u_site_rate``, the smoothed shares of blocked rows.

    Names without labels get the overall rate. With ``folds`` the frame's rows are labelled ones,
    and a row's rates count the other folds only, so that no tree is fitted on a rate that knows
    the row's label.
    """
    for key in ("_u_suffix", "_u_site"):
        rates = cut_to_table(block_counts(labelled, key, folds), "block_rates")
        size = rates.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length(key)).alias("b")).first()
        on = [key, "_u_fold"] if folds else [key]
        frame = frame.join(sized_broadcast(rates, size["n"], 48 + (size["b"] or 0)), on, "left")
        rate = (F.col("_u_blocked") + mean * PRIOR_ROWS) / (F.col("_u_rows") + PRIOR_ROWS)
        frame = frame.withColumn(f"{key}_rate", F.coalesce(rate, F.lit(mean))).drop("_u_blocked", "_u_rows")
    return frame


def assembled(frame: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[f"_u_{f}" for f in FEATURES], outputCol="_u_features").transform(frame)


def fit(frame: DataFrame, fit_rows: int = FIT_ROWS, rounds: int = 20, depth: int = 4, seed: int = 7):
    """Model and a function that adds rates to a ``lexical`` frame, from the rows a rule decides.

    The trees see at most ``fit_rows`` labelled URLs, the first by a hash of the URL's own
    features; suffix rates count all labelled URLs. Without labels of both kinds the model is
    the one label there is, allow if there is none.
    """
    label = (F.col("_u_match.verdict") == "block").cast("double").alias("label")
    own = [f"_u_{f}" for f in FEATURES if not f.endswith("_rate")]
    labelled = cut_to_table(
        frame.filter(F.col("_u_match").isNotNull()).select(
            label, "_u_suffix", "_u_site", *own, F.pmod(F.xxhash64(F.lit("fold"), "_u_site", *own), F.lit(FOLDS)).alias("_u_fold")
        ),
        "labelled_urls",
    )
    mean = labelled.agg(F.avg("label")).first()[0]
    if mean is None or mean in (0.0, 1.0):
        return None, (lambda x: x), "block" if mean else "allow"
    sample = labelled.orderBy(F.xxhash64("_u_site", *own)).limit(fit_rows)
    ready = cut_to_table(assembled(with_rates(sample, labelled, mean, folds=True)).select("label", "_u_features"), "url_features")
    trees = GBTClassifier(
        featuresCol="_u_features", labelCol="label", maxIter=rounds, maxDepth=depth, seed=seed, subsamplingRate=1.0
    )
    return trees.fit(ready), (lambda x: with_rates(x, labelled, mean)), "allow"


def judge_urls(
    pages: DataFrame, url_col: str = "url", rules: Sequence[SiteRule] = RULES, fit_rows: int = FIT_ROWS
) -> DataFrame:
    """``pages`` with host, path, rule, verdict and block_score.

    A fitting rule decides; for other URLs the trees do, and ``block_score`` is their
    probability of block (null without a model). A null or empty URL and one without ``://``
    has an empty host and path, fits no rule and is left to the trees. Repeated URLs are judged
    alike. Input columns of the new names give way. An empty table gives an empty one.
    """
    inside, names = shielded(pages)
    frame = lexical(inside, names[url_col], rules)
    model, rated, constant = fit(frame, fit_rows)
    if model is None:
        scored = frame.withColumns({"_u_score": F.lit(None).cast("double"), "_u_verdict": F.lit(constant)})
    else:
        from pyspark.ml.functions import vector_to_array

        model.setPredictionCol("_u_prediction").setProbabilityCol("_u_probability").setRawPredictionCol("_u_raw")
        scored = model.transform(assembled(rated(frame)))
        scored = scored.withColumn("_u_score", vector_to_array("_u_probability")[1])
        scored = scored.withColumn("_u_verdict", F.when(F.col("_u_score") > 0.5, "block").otherwise("allow"))
    return unshielded(
        scored,
        names,
        host=F.col("_u_host"),
        path=F.col("_u_path"),
        rule=F.col("_u_match.rule"),
        verdict=F.coalesce("_u_match.verdict", "_u_verdict"),
        block_score=F.col("_u_score"),
    )
