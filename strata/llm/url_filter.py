"""URL filter: rules first, then gradient-boosted trees over lexical features.

Rules say allow or block for a host with all its subdomains and the paths that
start with the rule's; the longest that fits wins. The trees judge the rest.
They are trained from labelled URLs (by default those that a rule decides): at
most ``MAX_LABELLED`` different ones of each verdict, the first in the order of
a hash, each with the weight of its copies. Suffix statistics, the share of
blocked URLs among the labelled ones under the host's last label and last two
labels, count every labelled URL, with two precautions, as rules are written by
suffix and their URLs would otherwise teach the suffix alone: a labelled URL's
share leaves out its own fold of hosts, and a suffix has a share only if labels
cover most of its URLs; under others the rest would be judged by a chosen part.

DataFrame functions and Spark's own ML only; no Python runs on an executor.

Defined cases: a null URL or one without ``://`` has an empty host and path, fits
no rule and is judged by its features like any other. A host whose suffix has no
share of its own has the overall one as its statistic. If the labelled URLs are all
of one verdict that is the method's; without any it allows. Repeated rows are
judged each. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import read_table, written

# (verdict, host, path); a rule is written as host and path together.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
MAX_LABELLED = 20_000  # of each verdict
TREES = 20
DEPTH = 4
PRIOR = 20.0  # labelled URLs that the overall share counts as in a suffix's
FOLDS = 5  # of hosts
COVERED = 0.5  # of a suffix's URLs: labelled ones from which it has a share
FEATURES = (
    "url_length", "host_length", "path_length", "host_labels", "depth", "digit_ratio", "hyphens", "entropy",
    "parameters", "has_fragment", "top_blocked", "domain_blocked", "domain_seen",
)


def parsed(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), ascii_uppercase, ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The longest fitting rule as struct(verdict, rule); null if none fits. Ties by the rule's text."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule_host + rule_path).alias("rule"))).otherwise(out)
    return out


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, from the lengths of their runs once sorted."""
    letters = F.array_sort(F.filter(F.split(text, ""), lambda c: c != ""))
    n = F.size(letters).cast("double")
    weigh = lambda run: run * F.log(F.greatest(run, F.lit(1.0)))
    start = F.struct(F.lit("").alias("c"), F.lit(0.0).alias("run"), F.lit(0.0).alias("total"))

    def step(acc: Column, c: Column) -> Column:
        same = acc["c"] == c
        return F.struct(c.alias("c"), F.when(same, acc["run"] + 1.0).otherwise(F.lit(1.0)).alias("run"), F.when(same, acc["total"]).otherwise(acc["total"] + weigh(acc["run"])).alias("total"))

    summed = F.aggregate(letters, start, step, lambda acc: acc["total"] + weigh(acc["run"]))
    return F.when(n > 0, F.log(n) - summed / n).otherwise(F.lit(0.0))


def lexical(urls: DataFrame) -> DataFrame:
    """urls(url, host, path, ...) with the lexical features and the host's suffixes added."""
    url = F.coalesce("url", F.lit(""))
    length = F.length(url).cast("double")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    labels = F.filter(F.split("host", r"\."), lambda x: x != "")
    return urls.withColumns(
        {
            "url_length": length,
            "host_length": F.length("host").cast("double"),
            "path_length": F.length("path").cast("double"),
            "host_labels": F.size(labels).cast("double"),
            "depth": F.regexp_count(F.col("path"), F.lit("[^/]+")).cast("double"),
            "digit_ratio": F.regexp_count(url, F.lit("[0-9]")) / F.greatest(length, F.lit(1.0)),
            "hyphens": F.regexp_count(F.col("host"), F.lit("-")).cast("double"),
            "entropy": entropy(url),
            "parameters": F.regexp_count(query, F.lit("[^&]+")).cast("double"),
            "has_fragment": F.contains(url, F.lit("#")).cast("double"),
            "top": F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels), F.lit(1)), 1)),
            "domain": F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2)),
        }
    )


def host_fold(host: Column) -> Column:
    return F.pmod(F.xxhash64(host), F.lit(FOLDS)).cast("int")


def suffix_shares(labelled: DataFrame, urls: DataFrame, suffix: str, overall: float) -> DataFrame:
    """suffix, fold, share of blocked outside the fold (smoothed to the overall one) and labelled URLs there; fold -1 is all.

    Only of suffixes whose labelled URLs are ``COVERED`` of these and the URLs
    to judge (``told`` is null).
    """
    counts = labelled.groupBy(suffix, host_fold(F.col("host")).alias("fold")).agg(F.sum("blocked").alias("b"), F.count(F.lit(1)).alias("n"))
    total = counts.groupBy(suffix).agg(F.sum("b").alias("all_b"), F.sum("n").alias("all_n"))
    others = urls.where("told IS NULL").groupBy(suffix).agg(F.count(F.lit(1)).alias("unlabelled"))
    total = written(total.join(others, suffix, "left").where(F.col("all_n") >= COVERED * (F.col("all_n") + F.coalesce("unlabelled", F.lit(0)))), f"{suffix}_counts")
    outside = counts.join(total, suffix).select(suffix, "fold", (F.col("all_b") - F.col("b")).alias("b"), (F.col("all_n") - F.col("n")).alias("n"))
    every = outside.unionByName(total.select(suffix, F.lit(-1).alias("fold"), F.col("all_b").alias("b"), F.col("all_n").alias("n")))
    return written(every.select(suffix, "fold", ((F.col("b") + PRIOR * overall) / (F.col("n") + PRIOR)).alias(f"{suffix}_blocked"), F.col("n").cast("double").alias(f"{suffix}_seen")), f"{suffix}_shares")


@dataclass
class UrlModel:
    """What labelled URLs have taught: the trees and the suffixes' shares, or the one verdict they all have."""

    overall: float
    trees: object = None
    top: DataFrame | None = None
    domain: DataFrame | None = None

    def with_shares(self, urls: DataFrame, fold: Column) -> DataFrame:
        rows = urls.withColumn("fold", fold)
        joined = rows.join(self.top.drop("top_seen"), ["top", "fold"], "left").join(self.domain, ["domain", "fold"], "left")
        return joined.fillna({"top_blocked": self.overall, "domain_blocked": self.overall, "domain_seen": 0.0})

    def scored(self, urls: DataFrame) -> DataFrame:
        """``urls`` with blocked_score, the chance of block."""
        if self.trees is None:
            return urls.withColumn("blocked_score", F.lit(self.overall))
        from pyspark.ml import functions as ML

        rows = self.trees.transform(_vector().transform(self.with_shares(urls, F.lit(-1))))
        return rows.withColumn("blocked_score", F.element_at(ML.vector_to_array("probability"), 2))


def _vector():
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(FEATURES), outputCol="features")


def read_urls(urls: DataFrame) -> DataFrame:
    """urls(url, ...) with host, path, features and suffixes."""
    host, path = parsed(F.col("url"))
    return lexical(urls.withColumns({"host": host, "path": path}))


def train(labelled: DataFrame, urls: DataFrame, max_labelled: int = MAX_LABELLED) -> UrlModel:
    """The model of ``labelled`` (features and blocked, 0.0 or 1.0); ``urls`` (features and told) are those that it shall judge."""
    from pyspark.ml.classification import GBTClassifier

    n, blocked = labelled.agg(F.count(F.lit(1)), F.coalesce(F.sum("blocked"), F.lit(0.0))).first()
    overall = blocked / n if n else 0.0
    if overall in (0.0, 1.0):
        return UrlModel(overall)
    model = UrlModel(overall, top=suffix_shares(labelled, urls, "top", overall), domain=suffix_shares(labelled, urls, "domain", overall))
    lexicals = [f for f in FEATURES if f not in ("top_blocked", "domain_blocked", "domain_seen")]
    # equal URLs of one verdict are one with their number; ties in the hash are ordered by the features
    key = F.xxhash64("host", "path", *lexicals)
    own = ["top", "domain", "blocked", *lexicals]
    copies = labelled.groupBy(*own, key.alias("key"), host_fold(F.col("host")).alias("fold")).agg(F.count(F.lit(1)).cast("double").alias("copies"))
    by_verdict = [copies.where(F.col("blocked") == v).orderBy("key", *lexicals, "top", "domain").limit(max_labelled) for v in (0.0, 1.0)]
    sample = model.with_shares(by_verdict[0].union(by_verdict[1]), F.col("fold"))
    sample = written(sample.select(*FEATURES, "blocked", "copies"), "labelled_urls")
    trees = GBTClassifier(featuresCol="features", labelCol="blocked", weightCol="copies", maxIter=TREES, maxDepth=DEPTH, seed=0)
    model.trees = trees.fit(_vector().transform(sample.orderBy(*FEATURES, "blocked", "copies")))
    return model


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    labelled: DataFrame | None = None,
    max_labelled: int = MAX_LABELLED,
    model: UrlModel | None = None,
) -> DataFrame:
    """page_id, host, path, rule, verdict and blocked_score (the trees' chance of block) of every page.

    ``labelled`` (url, blocked 0 or 1) are the URLs to learn from; by default
    those that a rule decides. ``model``: of an earlier ``train``, which is not repeated then.
    """
    found = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = read_urls(pages.select("page_id", "url")).withColumn("found", found)
    kept = ["page_id", "host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("told"), "top", "domain", *(f for f in FEATURES if f not in ("top_blocked", "domain_blocked", "domain_seen"))]
    rows = written(rows.select(*kept), "urls")
    if model is None:
        if labelled is None:
            taught = rows.where("told IS NOT NULL").withColumn("blocked", (F.col("told") == "block").cast("double"))
        else:
            taught = read_urls(labelled.where("blocked IN (0, 1)").select("url", F.col("blocked").cast("double").alias("blocked")))
        model = train(taught, rows, max_labelled)
    method = F.when(F.col("blocked_score") > 0.5, "block").otherwise("allow")
    return model.scored(rows).select("page_id", "host", "path", "rule", F.coalesce("told", method).alias("verdict"), "blocked_score")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
