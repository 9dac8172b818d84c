"""URL filters: host and path rules, and gradient-boosted trees on lexical features for the rest."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane.llm.shared import forget, stored

#: (verdict, host, path start). Fixed values of the registered query.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: The trees are fitted on at most so many labelled URLs, those of the smallest hash.
TRAIN_ROWS = 20_000
TREES, DEPTH, STEP = 12, 4, 0.3
#: What the statistics of labelled URLs are counted by: the host's last part, the one before it, and the path's ending.
KEYS = ("suffix", "name", "ending")
#: Weight of the overall share in a suffix's share of blocked URLs.
PRIOR_WEIGHT = 10.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ["f_length", "f_host_length", "f_path_length", "f_depth", "f_digits", "f_host_digits", "f_entropy", "f_host_entropy", "f_params", "f_host_parts", "f_hyphens",
            "f_fragment", "f_longest_part", "f_suffix_share", "f_suffix_count", "f_name_share", "f_ending_share"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null and where there is no `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits host or a parent domain of it and the start of the path; else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def _entropy(text: Column) -> Column:
    """Entropy of a text's characters, from the lengths of the runs of equal ones once they are sorted."""
    n = F.length(text)
    weigh = lambda run: F.when(run > 0, run * F.log(run)).otherwise(0.0)
    start = F.struct(F.lit("").alias("char"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))

    def count(s: Column, c: Column) -> Column:
        same = s["char"] == c
        return F.struct(c.alias("char"), F.when(same, s["run"] + 1.0).otherwise(1.0).alias("run"), (s["sum"] + F.when(same, 0.0).otherwise(weigh(s["run"]))).alias("sum"))

    runs = F.aggregate(F.array_sort(F.split(text, "")), start, count, lambda s: s["sum"] + weigh(s["run"]))
    return F.when(n > 0, F.log(n) - runs / n).otherwise(0.0)


def _digit_part(text: Column) -> Column:
    return F.when(F.length(text) > 0, F.length(F.regexp_replace(text, "[^0-9]", "")) / F.length(text)).otherwise(0.0)


def lexical(df: DataFrame, url: str) -> DataFrame:
    """Adds host, path, the keys of the suffix statistics and the features that need no statistics."""
    host, path = host_and_path(F.col(url))
    df = df.withColumn("host", host).withColumn("path", path)
    text = F.coalesce(F.col(url), F.lit(""))
    count = lambda c, ch: F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))
    names = F.split("host", r"\.")
    return (df.withColumn("suffix", F.substring_index("host", ".", -1))
            .withColumn("name", F.when(F.size(names) > 1, F.get(names, F.size(names) - 2)).otherwise(""))
            .withColumn("ending", F.regexp_extract("path", r"(\.[A-Za-z0-9]{1,8}|/)$", 1))
            .withColumns({
                "f_length": F.length(text), "f_host_length": F.length("host"), "f_path_length": F.length("path"), "f_depth": count(F.col("path"), "/"),
                "f_digits": _digit_part(text), "f_host_digits": _digit_part(F.col("host")), "f_entropy": _entropy(text), "f_host_entropy": _entropy(F.col("host")),
                "f_params": F.when(F.contains(text, F.lit("?")), 1 + count(text, "&")).otherwise(0), "f_host_parts": F.size(names), "f_hyphens": count(F.col("host"), "-"),
                "f_fragment": F.contains(text, F.lit("#")).cast("int"), "f_longest_part": F.array_max(F.transform(names, F.length))}))


def _with_shares(df: DataFrame, stats: dict[str, DataFrame], base: float) -> DataFrame:
    for key, table in stats.items():  # plain joins: the tables grow with the labelled URLs, and Spark broadcasts those that are small on disk
        df = df.join(table, key, "left")
        df = df.withColumn(f"f_{key}_share", (F.coalesce(f"{key}_blocked", F.lit(0)) + PRIOR_WEIGHT * base) / (F.coalesce(f"{key}_n", F.lit(0)) + PRIOR_WEIGHT))
    df = df.withColumn("f_suffix_count", F.log1p(F.coalesce("suffix_n", F.lit(0))))
    return df.withColumns({f: F.col(f).cast("double") for f in FEATURES})


class UrlModel:
    """Trees fitted on labelled URLs; with one class only, that class; without labels, allow."""

    def __init__(self, labelled: DataFrame, url_col: str, blocked_col: str):
        """`labelled`: URLs and whether each is blocked (1 or 0; null rows are left out).

        A URL counts once, as blocked if any of its rows says so. The shares and counts of
        suffixes, names and endings are those of all labelled URLs; the trees are fitted on the
        TRAIN_ROWS of the smallest hash, a bounded sample that is the same on every run."""
        rows = labelled.select(F.col(url_col).alias("url"), F.col(blocked_col).cast("double").alias("blocked")).dropna().groupBy("url").agg(F.max("blocked").alias("blocked"))
        rows = stored(lexical(rows, "url").select("url", "blocked", *KEYS), "urls")
        n, blocked = rows.agg(F.count("*"), F.coalesce(F.sum("blocked"), F.lit(0.0))).first()
        self.n, self.base, self.model = n, blocked / n if n else 0.0, None
        if not 0 < blocked < n:
            return
        self.stats = {key: stored(rows.groupBy(key).agg(F.count("*").alias(f"{key}_n"), F.sum("blocked").alias(f"{key}_blocked")), f"{key}-shares") for key in KEYS}
        sample = rows.select("url", "blocked").orderBy(F.xxhash64("url"), "url").limit(TRAIN_ROWS)
        train = stored(_with_shares(lexical(sample.repartition(4), "url"), self.stats, self.base).select("blocked", *FEATURES), "url-sample")
        forget(rows)
        self.assemble = VectorAssembler(inputCols=FEATURES, outputCol="f_all")
        gbt = GBTClassifier(featuresCol="f_all", labelCol="blocked", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=7)
        self.model = gbt.fit(self.assemble.transform(train))

    def score(self, df: DataFrame) -> DataFrame:
        """Adds `score`, the probability that a URL is blocked, to rows that `lexical` made."""
        if self.model is None:
            return df.withColumn("score", F.lit(float(self.base)))
        out = self.model.transform(self.assemble.transform(_with_shares(df, self.stats, self.base)))
        return out.withColumn("score", vector_to_array("probability")[1])


def filter_urls(pages: DataFrame, id_col: str, url_col: str, rules=RULES, labelled: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for each row of `pages`.

    A rule's verdict holds where one fits; elsewhere the trees judge. They are
    fitted on `labelled` (url, blocked 0/1) or, without it, on the URLs that the
    rules judge. A null URL, or one without `://`, has an empty host and path,
    so no rule; repeated rows and null ids stay rows; ties don't arise, as each
    row is judged alone; very long URLs are read whole, in time that grows little
    faster than their length; an empty table gives an empty result; other columns
    are ignored. Scoring needs no shuffle while the statistics are small enough to
    be broadcast; beyond that it joins them by suffix, name and ending."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    host, path = host_and_path(F.col("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    if labelled is None:
        judged = rows.withColumn("host", host).withColumn("path", path).withColumn("said", verdict).where("said is not null")
        labelled = judged.select("url", (F.col("said") == "block").cast("double").alias("blocked"))
    model = UrlModel(labelled, "url", "blocked")
    out = model.score(lexical(rows, "url")).withColumn("rule", rule).withColumn("verdict", F.coalesce(verdict, F.when(F.col("score") >= 0.5, "block").otherwise("allow")))
    return out.select("page_id", "host", "path", "rule", "verdict", "score")
