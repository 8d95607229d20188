"""URL filter: listed rules, and gradient-boosted trees on lexical features for URLs that no rule decides.

Rules name a host and a path prefix; the longest that fits decides. URLs that rules decide are the labelled ones: the trees
are trained on them and judge the rest. Features are numbers that SQL takes from the URL alone: lengths, depth, shares of
digits and other signs, entropy, counts of parameters, and how often labelled URLs of the same host suffix or path word are
blocked. Those shares come from all labelled URLs; each labelled URL is left out of its own shares, so that
the trees do not learn to trust a share that only repeats the label. Training takes at most ``TRAIN_ROWS`` labelled URLs, the
first by a hash of the URL.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to ``?``, ``#`` or the
end. Null URLs and those without ``://`` have an empty host and path, which no rule fits; they are judged like any other.
Labelled URLs of one class only decide for that class; without any, nothing is blocked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamsight.llm.common import fresh
from roamsight.sources.staging import stage

#: (rule, verdict)
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
TRAIN_ROWS = 4_000
TREES, DEPTH = 10, 4
MOST_RULES = 10_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host_: Column, path_: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest fitting rule, as struct (rule, verdict); null if none fits. A rule is ``host/path``."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"rules become part of the plan, so there may be up to {MOST_RULES}")
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        name, _, prefix = rule.partition("/")
        fits = ((host_ == name) | F.endswith(host_, F.lit(f".{name}"))) & F.startswith(path_, F.lit(f"/{prefix}"))
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def entropy(text: Column) -> Column:
    """Bits per character."""
    size = F.greatest(F.length(text), F.lit(1)).cast("double")
    signs = F.split(text, "")
    share = lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size
    parts = F.transform(F.array_distinct(signs), lambda c: F.when(c == "", F.lit(0.0)).otherwise(-share(c) * F.log2(share(c))))
    return F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def lexical(url: Column, host_: Column, path_: Column) -> dict[str, Column]:
    url = F.coalesce(url, F.lit(""))
    size = F.greatest(F.length(url), F.lit(1))
    return {
        "url_length": F.length(url).cast("double"),
        "host_length": F.length(host_).cast("double"),
        "path_length": F.length(path_).cast("double"),
        "host_depth": _count(host_, r"\."),
        "path_depth": _count(path_, "/"),
        "digit_ratio": _count(url, "[0-9]") / size,
        "host_digits": _count(host_, "[0-9]"),
        "hyphens": _count(url, "-"),
        "other_ratio": _count(url, "[^A-Za-z0-9]") / size,
        "parameters": F.when(F.contains(url, F.lit("?")), 1 + _count(url, "&")).otherwise(0.0),
        "secure": F.startswith(F.lower(url), F.lit("https")).cast("double"),
        "fragment": F.contains(url, F.lit("#")).cast("double"),
        "entropy": entropy(url),
        "host_entropy": entropy(host_),
    }


def _suffixes(host_: Column, path_: Column) -> Column:
    """Host suffixes of one and two labels, and the first word of the path, each under a name of its own."""
    labels = F.split(host_, r"\.")
    word = F.regexp_extract(path_, r"^/([^/]*)/", 1)
    return F.array(
        F.concat(F.lit("1 "), F.element_at(labels, -1)),
        F.concat(F.lit("2 "), F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")),
        F.concat(F.lit("3 "), word),
    )


SUFFIX_FEATURES = ["suffix_1", "suffix_2", "path_word"]


def with_suffix_shares(rows: DataFrame, key: str) -> DataFrame:
    """Smoothed shares of blocked URLs among labelled ones with the same suffix; 0.5 where none is known.

    ``rows`` has ``suffixes`` and ``label`` (1, 0 or null). A labelled row does not count for itself. The shares are
    few per label set but may be many, so they are joined by shuffling short rows, salted against frequent suffixes.
    """
    parts = rows.select(key, "label", F.posexplode("suffixes").alias("place", "suffix"))
    known = parts.where("label is not null").groupBy("suffix")
    known = known.agg(F.sum("label").alias("blocked"), F.count("*").alias("labelled"))
    salts = 16
    salted = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    parts = parts.withColumn("salt", F.pmod(F.xxhash64(key), F.lit(salts)).cast("int"))
    own = F.coalesce(F.col("label"), F.lit(0.0))
    blocked = F.coalesce(F.col("blocked"), F.lit(0.0)) - own
    labelled = F.coalesce(F.col("labelled"), F.lit(0)) - F.col("label").isNotNull().cast("int")
    shares = parts.join(salted, ["suffix", "salt"], "left").select(key, "place", ((blocked + 1) / (labelled + 2)).alias("share"))
    wide = shares.groupBy(key).agg(*[F.max(F.when(F.col("place") == i, F.col("share"))).alias(n) for i, n in enumerate(SUFFIX_FEATURES)])
    return rows.join(wide, key)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, url_col: str = "url") -> DataFrame:
    """Pages with ``host``, ``path``, ``rule``, ``verdict`` and ``block_probability`` (1 or 0 where a rule decides)."""
    urls = pages.select(F.col(url_col).alias("url")).distinct()  # one row per URL, however often it occurs
    urls = urls.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    urls = urls.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    urls = urls.withColumns(
        {
            "label": F.when(F.col("found.verdict") == "block", 1.0).when(F.col("found.verdict") == "allow", 0.0),
            "url_key": F.xxhash64(F.coalesce(F.col("url"), F.lit("")), F.col("url").isNull()),
            "suffixes": _suffixes(F.col("host"), F.col("path")),
        }
    )
    features = lexical(F.col("url"), F.col("host"), F.col("path"))
    rows = with_suffix_shares(urls, "url_key").withColumns(features).drop("suffixes")
    names = [*features, *SUFFIX_FEATURES]
    rows = stage(rows, "url_features")
    judged = _judged(rows, names)
    kept = judged.select(
        F.col("url").alias("judged_url"),
        F.col("host").alias("judged_host"),
        F.col("path").alias("judged_path"),
        F.col("found.rule").alias("judged_rule"),
        F.coalesce("found.verdict", F.when(F.col("p") >= 0.5, "block").otherwise("allow")).alias("judged_verdict"),
        F.coalesce("label", "p").alias("judged_p"),
    )
    results = ["host", "path", "rule", "verdict", "block_probability"]
    row = fresh(pages, "page")
    pages = pages.withColumn(row, F.col(url_col))
    out = pages.join(kept, pages[row].eqNullSafe(kept["judged_url"]), "left")
    columns = [pages[f"`{name}`"] for name in pages.columns if name.lower() not in {*results, row}]
    return out.select(*columns, *[F.col(f"judged_{n}").alias(n) for n in results[:-1]], F.col("judged_p").alias(results[-1]))


def _judged(rows: DataFrame, names: list[str]) -> DataFrame:
    """Rows with ``p``, the probability of block."""
    labelled = rows.where("label is not null")
    classes = {r.label: r["count"] for r in labelled.groupBy("label").count().collect()}  # two rows at most
    if len(classes) < 2:
        return rows.withColumn("p", F.lit(float(next(iter(classes), 0.0))))
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    model = fit(labelled, names)
    scored = model.transform(assembler.transform(rows))
    from pyspark.ml.functions import vector_to_array

    return scored.withColumn("p", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def fit(labelled: DataFrame, names: list[str], trees: int = TREES, depth: int = DEPTH, most: int = TRAIN_ROWS) -> GBTClassificationModel:
    """Boosted trees on at most ``most`` labelled rows; in one partition, as they are few, so that results repeat exactly."""
    chosen = labelled.select("url_key", "label", *names).orderBy("url_key").limit(most).coalesce(1).sortWithinPartitions("url_key")
    chosen = stage(VectorAssembler(inputCols=names, outputCol="features").transform(chosen).select("label", "features"), "url_training")
    return GBTClassifier(featuresCol="features", labelCol="label", maxIter=trees, maxDepth=depth, seed=17).fit(chosen)
