"""URL filter: allow and block rules, and boosted trees for what no rule fits.

The rules label the urls they fit.  Gradient-boosted trees learn from a bounded
sample of those, on lexical features alone: lengths, depth, shares of digits,
entropy, parameters and statistics of the host's suffix, by itself and together
with the first part of the path.  Everything is built
from DataFrame functions and Spark ML; no Python runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, ensure_checkpoint_dir

TRAINING_URLS = 100_000
TREES, DEPTH, RATE, SEED = 20, 4, 0.2, 42
SMOOTHING = 20.0
PART_BITS = 12  # urls are counted in so many parts of their hash's range, by its sign too

#: Fixed values: (verdict, host and path).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

LEXICAL = (
    "url_length", "host_length", "path_length", "depth", "host_labels", "digit_ratio",
    "letter_ratio", "hyphens", "entropy", "parameters", "longest_segment", "secure", "fragment",
)
SUFFIX = ("suffix_block_rate", "suffix_frequency", "branch_block_rate")


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    empty for null and where there is no ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule(host_name: Column, url_path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null where none does."""
    name = verdict = F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        rule_host, slash, rest = text.partition("/")
        own = (host_name == rule_host) | host_name.endswith(f".{rule_host}")
        fits = own & url_path.startswith(slash + rest)
        name = F.when(fits, text).otherwise(name)
        verdict = F.when(fits, said).otherwise(verdict)
    return name, verdict


def _entropy(text: Column) -> Column:
    """Bits per character of a text's own character shares."""
    size = F.length(text)

    def part(char: Column) -> Column:
        share = (size - F.length(F.replace(text, char, F.lit("")))) / size
        return -share * F.log2(share)

    chars = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    bits = F.aggregate(F.transform(chars, part), F.lit(0.0), lambda a, b: a + b)
    return F.when(size == 0, 0.0).otherwise(bits)


def lexical(urls: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with host, path, suffix and the lexical features."""
    text = F.coalesce(F.col(url), F.lit(""))
    size = F.greatest(F.length(text), F.lit(1))
    parts = F.split(F.col("path"), "/")
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    matches = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    return urls.withColumns({"host": host(F.col(url)), "path": path(F.col(url))}).withColumns(
        {
            "suffix": F.substring_index("host", ".", -1),
            "branch": F.concat(F.substring_index("host", ".", -1), F.lit("/"), F.coalesce(F.get(parts, 1), F.lit(""))),
            "url_length": F.length(text).cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_length": F.length("path").cast("double"),
            "depth": F.size(F.filter(parts, lambda p: p != "")).cast("double"),
            "host_labels": F.size(F.split("host", r"\.")).cast("double"),
            "digit_ratio": matches("[0-9]") / size,
            "letter_ratio": matches("[A-Za-z]") / size,
            "hyphens": matches("-"),
            "entropy": _entropy(text),
            "parameters": F.when(query == "", 0.0).otherwise(
                F.size(F.split(query, "&")).cast("double")
            ),
            "longest_segment": F.array_max(F.transform(parts, F.length)).cast("double"),
            "secure": F.lower(text).startswith("https:").cast("double"),
            "fragment": text.contains("#").cast("double"),
        }
    )


@dataclass(frozen=True)
class UrlModel:
    """Fitted trees, or none where the labels are of one class or missing, and
    the statistics of suffixes and branches they were fitted with; branches are
    those of the training urls, and so not more than these."""

    trees: GBTClassificationModel | None
    suffixes: DataFrame
    block_rate: float
    branches: DataFrame | None = None


def _smoothed(blocked: Column, labelled: Column, block_rate: float) -> Column:
    return (blocked + SMOOTHING * block_rate) / (labelled + SMOOTHING)


def _with_statistics(features: DataFrame, model: UrlModel) -> DataFrame:
    known = features.join(model.suffixes, "suffix", "left")
    if model.branches is None:
        known = known.withColumn("branch_block_rate", F.lit(None).cast("double"))
    else:
        known = known.join(F.broadcast(model.branches), "branch", "left")
    usual = F.coalesce("suffix_block_rate", F.lit(model.block_rate))
    return known.withColumns(
        {
            "suffix_block_rate": usual,
            "suffix_frequency": F.coalesce("suffix_frequency", F.lit(0.0)),
            "branch_block_rate": F.coalesce("branch_block_rate", usual),
        }
    )


def _assembled(features: DataFrame) -> DataFrame:
    columns = [*LEXICAL, *SUFFIX]
    return VectorAssembler(inputCols=columns, outputCol="features").transform(features)


def _sampled(labelled: DataFrame, at_most: int, work: Scratch) -> DataFrame:
    """``url, label, copies``: of the distinct labelled urls at most so many, of
    each class as many as its share, at least one; the first by hash.

    The urls are counted by the first bits of their hash, which tells where to
    stop, so that only little more than the sample is ever put in order.
    """
    place = F.xxhash64("url")
    distinct = work.keep(
        labelled.groupBy("url", "label").agg(F.count(F.lit(1)).cast("double").alias("copies"))
        .withColumns({"place": place, "part": F.shiftright(place, 64 - PART_BITS)})
    )
    counted = distinct.groupBy("label", "part").count().orderBy("part").collect()
    sizes = {label: sum(r["count"] for r in counted if r.label == label) for label in (0.0, 1.0)}
    blocked = round(at_most * sizes[1.0] / sum(sizes.values()))
    blocked = max(1, min(at_most - 1, blocked))
    chosen = []
    for label, wanted in ((0.0, at_most - blocked), (1.0, blocked)):
        seen, last = 0, None
        for row in counted:
            if row.label == label and seen < wanted:
                seen, last = seen + row["count"], row.part
        first = distinct.where((F.col("label") == label) & (F.col("part") <= last))
        chosen.append(first if seen <= wanted else first.orderBy("place", "url").limit(wanted))
    return chosen[0].unionByName(chosen[1]).select("url", "label", "copies")


def fit(pages: DataFrame, rules: tuple = RULES, training_urls: int = TRAINING_URLS) -> UrlModel:
    """Fit on distinct urls that a rule fits, at most ``training_urls`` (two or
    more) of them, each weighted by the rows it has.  Statistics of suffixes are
    taken over all pages.

    Without labels of both classes there is nothing to learn and the share of
    blocked labels decides.
    """
    spark = pages.sparkSession
    work = Scratch(spark, "urls")
    urls = pages.select("url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    said = rule(F.col("host"), F.col("path"), rules)[1]
    marked = urls.withColumn("label", (said == "block").cast("double"))
    suffixes = work.keep(
        marked.groupBy(F.substring_index("host", ".", -1).alias("suffix")).agg(
            F.count(F.lit(1)).alias("n"), F.count("label").alias("labelled"),
            F.coalesce(F.sum("label"), F.lit(0.0)).alias("blocked"),
        )
    )
    labelled, blocked = suffixes.agg(F.sum("labelled"), F.sum("blocked")).first()
    block_rate = blocked / labelled if labelled else 0.0
    rate = _smoothed(F.col("blocked"), F.col("labelled"), block_rate)
    suffixes = suffixes.select(
        "suffix", rate.alias("suffix_block_rate"), F.log1p("n").alias("suffix_frequency")
    )
    if not 0.0 < block_rate < 1.0:
        return UrlModel(None, suffixes, block_rate)
    steps = Scratch(spark, "url-sample")
    sample = _sampled(marked.where(F.col("label").isNotNull()), max(2, training_urls), steps)
    known = lexical(steps.keep(sample))
    rate = _smoothed(F.sum(F.col("label") * F.col("copies")), F.sum("copies"), block_rate)
    branches = work.keep(known.groupBy("branch").agg(rate.alias("branch_block_rate")))
    model = UrlModel(None, suffixes, block_rate, branches)
    training = _assembled(_with_statistics(known, model))
    training = steps.keep(training.select("features", "label", "copies"))
    ensure_checkpoint_dir(spark)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, seed=SEED, weightCol="copies")
    fitted = trees.fit(training)
    steps.remove()
    return UrlModel(fitted, suffixes, block_rate, branches)


def judge(pages: DataFrame, model: UrlModel, rules: tuple = RULES) -> DataFrame:
    """``page_id, url, host, path, rule, verdict`` and ``block_score``, the
    trees' probability, one row per row of ``pages``.

    A null url, or one without ``://``, has an empty host and path, fits no rule
    and is judged by its features alone.  Without trees the share of blocked
    labels decides.  Repeated rows are judged each; other columns are neither
    read nor returned.
    """
    name, said = rule(F.col("host"), F.col("path"), rules)
    features = _with_statistics(lexical(pages.select("page_id", "url")), model)
    if model.trees is None:
        scored = features.withColumn("block_score", F.lit(model.block_rate))
    else:
        from pyspark.ml.functions import vector_to_array

        scored = model.trees.transform(_assembled(features)).withColumn(
            "block_score", vector_to_array("probability")[1]
        )
    learned = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return scored.select(
        "page_id", "url", "host", "path", name.alias("rule"),
        F.coalesce(said, learned).alias("verdict"), "block_score",
    )
