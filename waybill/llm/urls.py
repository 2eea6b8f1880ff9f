"""URL filter: fixed rules first, gradient-boosted trees on lexical features for the rest.

A rule (verdict, host, path) fits its host and all subdomains where the URL's path begins with the
rule's. The longest rule that fits wins. URLs that a rule decides are the labelled ones: a bounded
sample of them trains the trees. Statistics of host suffixes (how many URLs, and how many of them
blocked) are counted over all labelled URLs, with partial sums before the shuffle.

Defined cases: a null URL or one without ``://`` has an empty host and path; no rule fits it and the
trees judge it by what it has. Unless URLs of both verdicts are labelled, the rest is allowed.
Rows are judged one by one, so repeated rows repeat and null ids stay; other columns are ignored.
"""

from __future__ import annotations

import string
from typing import NamedTuple

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from waybill.llm.tables import keep

BLOCK, ALLOW = "block", "allow"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


# a dot before a host that is not the whole one marks a subdomain
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LEXICAL = ("url_length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio", "host_digit_ratio",
           "hyphens", "entropy", "parameters", "has_fragment", "is_https", "has_extension", "longest_label")
SUFFIX = ("top_rate", "top_count", "site_rate", "site_count")


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL."""
    host = F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit(""))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[Rule], answer) -> Column:
    """``answer(rule)`` of the longest rule that fits, of equals the first; else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.lit(answer(rule))).otherwise(out)
    return out


def _lexical(df: DataFrame) -> DataFrame:
    url, host, path = F.coalesce(F.col("url").cast("string"), F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)

    def occurrences(text: Column, pattern: str) -> Column:
        return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))

    def bits(total: Column, char: Column) -> Column:
        p = (F.length(url) - F.length(F.replace(url, char, F.lit("")))) / F.length(url)
        return total - p * F.log2(p)

    return df.withColumns({
        "url_length": F.length(url), "host_length": F.length(host), "path_length": F.length(path),
        "host_depth": F.size(F.split(host, r"\.")), "path_depth": occurrences(path, "/"),
        "digit_ratio": share(occurrences(url, "[0-9]"), F.length(url)),
        "host_digit_ratio": share(occurrences(host, "[0-9]"), F.length(host)),
        "hyphens": occurrences(host, "-"),
        "entropy": F.aggregate(F.array_distinct(F.filter(F.split(url, ""), lambda c: c != "")), F.lit(0.0), bits),
        "parameters": F.when(query == "", 0).otherwise(F.size(F.split(query, "[&;]"))),
        "has_fragment": url.contains("#").cast("int"), "is_https": url.startswith("https://").cast("int"),
        "has_extension": path.rlike(r"\.[A-Za-z0-9]{1,5}$").cast("int"),
        "longest_label": F.array_max(F.transform(F.split(host, r"\."), F.length)),
        "top": F.element_at(F.split(host, r"\."), -1),
        "site": F.concat_ws(".", F.slice(F.split(host, r"\."), -F.least(F.lit(2), F.size(F.split(host, r"\."))), 2)),
    })


def _with_suffixes(df: DataFrame, labelled: DataFrame, prior: float = 20.0) -> DataFrame:
    """Adds the smoothed block rate and the log count of the host's last label and last two labels."""
    totals = labelled.agg(F.avg("y")).first()[0]
    rate = 0.5 if totals is None else float(totals)
    for name in ("top", "site"):
        counts = labelled.groupBy(name).agg(
            ((F.sum("y") + prior * rate) / (F.count(F.lit(1)) + prior)).alias(f"{name}_rate"),
            F.log1p(F.count(F.lit(1)).cast("double")).alias(f"{name}_count"))
        df = df.join(counts, name, "left").fillna({f"{name}_rate": rate, f"{name}_count": 0.0})
    return df


def _assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[*LEXICAL, *SUFFIX], outputCol="features", handleInvalid="keep").transform(df)


def train(rows: DataFrame, bound: int, seed: int = 11) -> GBTClassificationModel | None:
    """Trees from about ``bound`` rows (y, features) at most, chosen by a hash of the URL; None unless
    both labels occur."""
    seen = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    if len(seen) < 2:
        return None
    share, steps = min(1.0, bound / sum(seen.values())), 1 << 24
    sample = rows.filter(F.pmod(F.xxhash64("url", "page_id", F.lit(seed)), F.lit(steps)) < int(share * steps))
    sample = keep(sample.select("y", *LEXICAL, *SUFFIX), "urls")
    trees = GBTClassifier(labelCol="y", maxIter=15, maxDepth=4, maxBins=64, stepSize=0.2, seed=seed, checkpointInterval=-1)
    return trees.fit(_assembled(sample).select(F.col("y").cast("double").alias("y"), "features"))


def judged(pages: DataFrame, rules: list[Rule], bound: int = 20_000, limit: float = 0.5) -> DataFrame:
    """Per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict, block_score."""
    host, path = url_parts(F.col("url").cast("string"))
    rows = pages.select("page_id", "url").withColumns({"host": host, "path": path})
    host, path = F.col("host"), F.col("path")
    rows = rows.withColumns({"rule": fitting_rule(host, path, rules, lambda r: r.host + r.path),
                             "ruled": fitting_rule(host, path, rules, lambda r: r.verdict)})
    rows = _lexical(rows).withColumn("y", (F.col("ruled") == BLOCK).cast("int"))
    labelled = rows.filter("ruled is not null")
    featured = _with_suffixes(rows, labelled)
    model = train(featured.filter("ruled is not null"), bound)
    if model is None:
        scored = featured.withColumn("block_score", F.lit(0.0))
    else:
        scored = model.transform(_assembled(featured)).withColumn("block_score", vector_to_array("probability")[1])
    verdict = F.coalesce("ruled", F.when(F.col("block_score") >= limit, BLOCK).otherwise(ALLOW))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "block_score")
