"""URL verdicts: host and path rules first, gradient-boosted trees on lexical features for the rest. DataFrame functions only.

The trees learn from labelled URLs; the registered query labels them by the rules. Features: lengths, depth, digit ratio, character entropy, parameter
counts and suffix statistics (how often the last one and two host labels were blocked, smoothed, in a fixed number of hash slots so that the
tables stay bounded at any number of hosts).
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from .tables import keep, plain

TRAIN_ROWS = 50_000  # bound of the labelled sample the trees learn from
SLOTS = 4096         # hash slots of the suffix statistics
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ["length", "host_length", "path_length", "depth", "host_labels", "digit_ratio", "host_digits", "entropy", "parameters", "query_length", "hyphens", "has_fragment", "has_extension", "secure", "suffix_rate", "suffix_weight", "site_rate", "site_weight"]


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one or for null."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host(rest: Column) -> Column:
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)


def path(rest: Column) -> Column:
    return F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matching_rule(host_col: Column, path_col: Column, rules: dict[str, str]) -> Column:
    """The longest rule (``host/path``) that fits a host or a parent of it and the start of the path; null if none fits. Equal lengths: the first by text."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r), r), reverse=True):
        name, slash, rest = rule.partition("/")
        name = name.translate(str.maketrans(UPPER, LOWER))
        out = F.when(((host_col == name) | F.endswith(host_col, F.lit("." + name))) & F.startswith(path_col, F.lit(slash + rest)), F.lit(rule)).otherwise(out)
    return out


def verdict_of(rule: Column, rules: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for name, verdict in rules.items():
        out = F.when(rule == name, verdict).otherwise(out)
    return out


def entropy(text: Column) -> Column:
    """Bits for each character of the text."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    letters = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    share = lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n
    return F.aggregate(letters, F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c)))


def lexical(urls: DataFrame) -> DataFrame:
    """Adds the lexical features and the hash slots of the host's suffixes to (url, host, path)."""
    text = F.coalesce("url", F.lit(""))
    digits = lambda c: F.length(F.regexp_replace(c, "[^0-9]", ""))
    params = F.regexp_extract(text, r"\?([^#]*)", 1)
    labels = F.split("host", r"\.")
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(SLOTS)).cast("int")
    length = F.length(text)
    return urls.select("*", length.alias("length"), F.length("host").alias("host_length"), F.length("path").alias("path_length"),
                       (F.length("path") - F.length(F.replace("path", F.lit("/"), F.lit("")))).alias("depth"), F.size(labels).alias("host_labels"),
                       (digits(text) / F.greatest(length, F.lit(1))).alias("digit_ratio"), digits(F.col("host")).alias("host_digits"), entropy(text).alias("entropy"),
                       F.when(params == "", 0).otherwise(F.size(F.split(params, "&"))).alias("parameters"), F.length(params).alias("query_length"),
                       (length - F.length(F.replace(text, F.lit("-"), F.lit("")))).alias("hyphens"), F.contains(text, F.lit("#")).cast("int").alias("has_fragment"),
                       F.rlike("path", F.lit(r"\.[A-Za-z0-9]{1,5}$")).cast("int").alias("has_extension"), F.startswith(text, F.lit("https://")).cast("int").alias("secure"),
                       slot(F.element_at(labels, -1)).alias("suffix_slot"), slot(F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2))).alias("site_slot"))


def suffix_statistics(labelled: DataFrame, slot: str, name: str, prior: float) -> DataFrame:
    """(slot, rate, weight) of the labelled rows: at most ``SLOTS`` rows."""
    return labelled.groupBy(slot).agg(((F.sum("label") + 2 * prior) / (F.count("*") + 2)).alias(f"{name}_rate"), F.log1p(F.count("*")).alias(f"{name}_weight"))


def block_scores(urls: DataFrame, labelled: DataFrame, train_rows: int = TRAIN_ROWS, trees: int = 12, depth: int = 4) -> DataFrame:
    """Adds ``score``, the probability of label 1 (block), to ``urls`` (id, url, host, path), learnt from ``labelled`` (the same columns and label).

    The trees see a hash sample of about ``train_rows`` labelled rows; suffix statistics count them all. Without labelled rows every score is 0, with one
    class only it is that class.
    """
    known = lexical(labelled)
    n, positive = labelled.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not n or positive in (0, n):
        return urls.withColumn("score", F.lit(float(bool(n) and positive == n)))
    stats = [(s, name, keep(suffix_statistics(known, s, name, positive / n), "suffixes")) for s, name in (("suffix_slot", "suffix"), ("site_slot", "site"))]

    def featured(df):
        for slot, name, table in stats:
            # at most SLOTS rows by construction
            df = df.join(F.broadcast(table), slot, "left").fillna({f"{name}_rate": positive / n, f"{name}_weight": 0.0})
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)

    sample = known.filter(F.pmod(F.xxhash64("id", "url"), F.lit(n)) < train_rows) if n > train_rows else known
    train = featured(keep(sample, "urls")).select("features", F.col("label").cast("double").alias("label"))
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7).fit(train.repartition(8))
    scored = model.transform(featured(lexical(urls)))
    return scored.select(*urls.columns, vector_to_array("probability")[1].alias("score"))


def judge(pages: DataFrame, rules: dict[str, str], labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row. ``rules``: ``host/path`` to allow or block.

    ``labelled``: rows (id, url, label) with 1 for block; by default the pages that a rule fits. A null url, or one without ``://``, has empty host and path,
    no rule, and gets the trees' verdict like any other. Repeated rows are judged each; other columns are ignored.
    """
    def parsed(df, **columns):
        rest = after_scheme(F.col("url"))
        return plain(df, **columns).withColumns({"host": host(rest), "path": path(rest)})

    urls = parsed(pages, id=id_col, url=url_col)
    urls = urls.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    if labelled is None:
        known = urls.filter("rule IS NOT NULL").withColumn("label", (verdict_of(F.col("rule"), rules) == "block").cast("int")).drop("rule")
    else:
        known = parsed(labelled, id="id", url="url", label="label").filter("label IS NOT NULL")
    scored = block_scores(urls, known, train_rows)
    return scored.select(F.col("id").alias("page_id"), "host", "path", "rule", F.coalesce(verdict_of(F.col("rule"), rules), F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")
