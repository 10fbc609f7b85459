"""URL filters: host and path rules, and a logistic regression for URLs that no rule fits.

The regression sees hashed character n-grams of host and path, trained on a small table of
labelled URLs. Everything is SQL functions and Spark's own feature and regression stages.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.shared import stored

GRAM_SIZES = (3, 4, 5)
BUCKETS = 1 << 15
TRAINING_ROWS = 20_000
ROUNDS = 100
SHRINKAGE = 1e-4


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """Up to the first of ``/ ? #``, letters A-Z lower-cased; empty for NULL or no scheme."""
    host = F.regexp_extract(after_scheme(F.coalesce(url, F.lit(""))), r"(?s)^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?`` or ``#``."""
    return F.regexp_extract(after_scheme(F.coalesce(url, F.lit(""))), r"(?s)^[^/?#]*([^?#]*)", 1)


def grams(text: Column, sizes: tuple[int, ...] = GRAM_SIZES) -> Column:
    """Character n-grams of a text marked at both ends, each carrying nothing but its letters."""
    marked = F.concat(F.lit("^"), text, F.lit("$"))
    parts = [
        F.when(
            F.length(marked) >= size,
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.length(marked) - (size - 1), F.lit(1))),
                lambda i, size=size: F.substring(marked, i, F.lit(size)),
            ),
        ).otherwise(F.array().cast("array<string>"))
        for size in sizes
    ]
    return F.concat(*parts)


def url_grams(host: Column, path: Column) -> Column:
    of_host = F.transform(grams(host), lambda g: F.concat(F.lit("h:"), g))
    return F.concat(of_host, F.transform(grams(path), lambda g: F.concat(F.lit("p:"), g)))


def featured(urls: DataFrame) -> DataFrame:
    """Adds ``features`` to ``host`` and ``path``: how often each hashed n-gram occurs."""
    return HashingTF(numFeatures=BUCKETS, inputCol="grams", outputCol="features").transform(
        urls.withColumn("grams", url_grams(F.col("host"), F.col("path")))
    ).drop("grams")


def train(labelled: DataFrame, rows: int = TRAINING_ROWS) -> LogisticRegressionModel | None:
    """Regression on the ``rows`` labelled URLs (``host, path, blocked``) with smallest hashes.

    Both labels weigh the same in total. None when the table does not hold both labels.
    """
    sample = labelled.where(F.col("blocked").isNotNull()).select(
        "host", "path", F.col("blocked").cast("double").alias("label")
    ).distinct().orderBy(F.xxhash64("host", "path"), "host", "path", "label").limit(rows)
    size = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    if len(size) < 2:
        return None
    total = sum(size.values())
    weight = F.when(F.col("label") == 1.0, total / (2.0 * size[1.0])).otherwise(
        total / (2.0 * size[0.0])
    )
    learner = LogisticRegression(
        maxIter=ROUNDS, regParam=SHRINKAGE, weightCol="weight", standardization=False
    )
    return learner.fit(featured(sample).withColumn("weight", weight).coalesce(1))


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, fitting``: the rules whose host is the host or a parent domain of it."""
    by_host = rules.where(F.col("rule").contains("/")).select(
        F.regexp_extract("rule", r"(?s)^([^/]*)", 1).alias("suffix"),
        F.regexp_extract("rule", r"(?s)^[^/]*(.*)$", 1).alias("starts"),
        "rule", "verdict",
    ).groupBy("suffix").agg(
        F.collect_set(F.struct(
            F.length("rule").alias("size"), "rule", "verdict", "starts"
        )).alias("fitting")
    )
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    return (
        hosts.select("host", F.explode(F.array_distinct(suffixes)).alias("suffix"))
        .join(by_host, "suffix")
        .groupBy("host")
        .agg(F.flatten(F.collect_list("fitting")).alias("fitting"))
    )


def parsed(pages: DataFrame, id_column: str, url_column: str) -> DataFrame:
    url = F.col(url_column)
    return pages.select(
        F.col(id_column).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path")
    )


def with_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds the longest fitting ``rule`` and its verdict as ``ruled``, NULL where none fits.

    A rule is a text ``host/path`` with a verdict. It fits its host and all subdomains if the
    path starts with the rule's. Rules are matched once per distinct host. Of equally long rules
    the largest in text order wins, of equal texts with two verdicts ``block``.
    """
    # Written, so that the join's both sides are plain scans and a hot host's partition is split.
    found = stored(host_rules(urls.select("host").distinct(), rules), "host-rules")
    fits = F.filter("fitting", lambda r: F.startswith(F.col("path"), r["starts"]))
    best = F.array_max(fits)
    return urls.join(found, "host", "left").select(
        "page_id", "host", "path", best["rule"].alias("rule"), best["verdict"].alias("ruled")
    )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    labelled: DataFrame | None = None,
    threshold: float = 0.5,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for every row of ``pages``.

    ``score`` is the regression's probability of block; where no rule fits, the verdict is block
    from ``threshold`` on. ``labelled`` holds ``host, path, blocked``; without it the pages that a
    rule judges are the labelled table. A table without both labels trains nothing: scores are
    NULL and pages without rule are allowed. NULL urls and urls without ``://`` have an empty host
    and path and are judged like any other. Repeated rows are judged alike; long urls whole.
    Other columns are not read.
    """
    urls = with_rules(parsed(pages, id_column, url_column), rules)
    if labelled is None:
        labelled = urls.where("ruled IS NOT NULL").select(
            "host", "path", (F.col("ruled") == "block").alias("blocked")
        )
    model = train(labelled)
    if model is None:
        scored = urls.withColumn("score", F.lit(None).cast("double"))
    else:
        scored = model.transform(featured(urls)).withColumn(
            "score", vector_to_array("probability")[1]
        )
    learned = F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", learned).alias("verdict"), "score"
    )
