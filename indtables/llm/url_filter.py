"""URL filter: allow/block rules, and gradient-boosted trees for the rest.

DataFrame functions and Spark's own GBTClassifier only. A rule is a host and a
path; it fits its host and all subdomains where the url's path starts with the
rule's; the longest rule that fits wins. Where none fits, trees judge lexical
features: lengths, depth, digit share, entropy, parameter count, hyphens, and
suffix statistics: the share of bad urls among labelled ones with the same
last one, two or three host labels, smoothed.

Labelled urls are an argument (``url``, ``label`` 1 = bad). Without them the
urls of the table whose registrable name holds a word of ``SEED_WORDS`` are
labelled bad and the others good, in the labelled folds only (``folds`` of 10
by a hash of the url), so the trees see no label of the rest. Training uses at
most ``max_labels`` rows, up to half of them of each label (those of the
smallest hash), so rare bad urls are not crowded out; both labels weigh the
same in the fit. Of each label two fifths give the suffix statistics, two
fifths fit the trees, one fifth is held out for ``accuracy``. Every url is
judged.

The rate tables are bounded by ``max_labels`` and broadcast; nothing else
leaves the executors but the trees.

Defined results: a null url, or one without "://", has an empty host and path,
fits no rule and is judged on its features (a null as the empty url); repeated
rows each give a row; ties between equally long rules go to block; an empty
table gives no rows; without labels of both kinds the trees are left out and
the rest is allowed; other columns are ignored; long urls are whole."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indtables.llm.common import cut
from indtables.llm.lexical import LOWER, UPPER, entropy, rates, sample, share, with_rates

# Words that mark a registrable name as bad when no labels are given.
SEED_WORDS = ["spam", "casino", "bets", "pills", "adult", "ads"]
MAX_LABELS = 20_000
TREES, DEPTH = 12, 4
SUFFIXES = ["suffix1", "suffix2", "suffix3"]
FEATURES = [
    "n_url", "n_host", "n_path", "n_query", "depth", "n_labels", "n_params", "hyphens",
    "digit_share", "symbol_share", "url_entropy", "host_entropy", "suffix1_rate", "suffix2_rate", "suffix3_rate",
]


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def best_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. ``rules``:
    (verdict, "host/path")."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # shortest first, so the longest is tested first in the end
    for said, text in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block")):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def features(urls: DataFrame) -> DataFrame:
    """Adds the lexical features to (url, host, path)."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    double = {
        "n_url": F.length(url), "n_host": F.length(host), "n_path": F.length(path), "n_query": F.length(query),
        "depth": F.regexp_count(path, F.lit("/[^/]")), "n_labels": F.size(labels),
        "n_params": F.regexp_count(query, F.lit("[^&]+")), "hyphens": F.regexp_count(host, F.lit("-")),
        "digit_share": share(url, "0-9"), "symbol_share": share(url, "^A-Za-z0-9"),
        "url_entropy": entropy(url), "host_entropy": entropy(host),
    }
    suffix = {s: F.substring_index(host, ".", -n) for n, s in enumerate(SUFFIXES, 1)}
    return urls.withColumns({k: v.cast("double") for k, v in double.items()} | suffix)


def seed_labels(urls: DataFrame, folds: int = 5) -> DataFrame:
    """(url, label) of the labelled folds, by the seed words."""
    name = F.translate(host_path(F.col("url"))[0], UPPER, LOWER)
    bad = F.split(F.regexp_replace(name, r"\.[^.]*$", ""), "[.-]")
    words = F.array(*[F.lit(w) for w in SEED_WORDS])
    return (
        urls.filter(F.col("url").isNotNull() & (F.pmod(F.xxhash64("url", F.lit(7)), F.lit(10)) < folds))
        .select("url", F.arrays_overlap(bad, words).cast("int").alias("label"))
        .distinct()
    )


class Filter:
    """Trained trees and their suffix statistics."""

    def __init__(self, labels: DataFrame, max_labels: int = MAX_LABELS):
        found = labels.filter(F.col("url").isNotNull() & F.col("label").isNotNull()).select("url", "label")
        found = cut(sample(found, ["url", "label"], max_labels), "url-labels")
        host, path = host_path(F.col("url"))
        found = features(found.withColumn("host", host).withColumn("path", path))
        known = found.filter(F.col("fold") < 2)
        self.tables = {s: cut(rates(known, s), f"url-{s}") for s in SUFFIXES}
        ready = self.vectors(found.filter(F.col("fold") >= 2)).select("features", "label", "weight", "fold")
        ready = cut(ready.coalesce(4), "url-training")  # at most max_labels rows
        fit = ready.filter(F.col("fold") < 4)
        self.model = None
        if fit.select("label").distinct().count() == 2:
            self.model = GBTClassifier(labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, seed=42).fit(fit)
        self.held = ready.filter(F.col("fold") == 4)

    def vectors(self, df: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(with_rates(df, self.tables))

    def judge(self, df: DataFrame) -> DataFrame:
        """Adds ``bad`` (boolean) to rows with the features."""
        if self.model is None:
            return df.withColumn("bad", F.lit(False))
        return self.model.transform(self.vectors(df)).withColumn("bad", F.col("prediction") >= 0.5)

    def accuracy(self) -> float | None:
        """Balanced accuracy on the held-out fifth."""
        if self.model is None:
            return None
        right = self.model.transform(self.held).withColumn("right", (F.col("prediction") == F.col("label")).cast("int"))
        return right.groupBy("label").agg(F.avg("right").alias("r")).agg(F.avg("r")).first()[0]


def judged(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    labels: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    max_labels: int = MAX_LABELS,
) -> DataFrame:
    """(id, host, path, rule, verdict) for every row."""
    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    host, path = host_path(F.col("url"))
    urls = urls.withColumn("host", host).withColumn("path", path)
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    trained = Filter(seed_labels(urls) if labels is None else labels, max_labels)
    out = trained.judge(features(urls.withColumn("rule", rule).withColumn("said", verdict)))
    own = F.when(F.col("bad"), "block").otherwise("allow")
    return out.select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("said", own).alias("verdict")
    )
