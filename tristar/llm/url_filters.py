"""URL filters: rules by host and path, and gradient-boosted trees for the rest.

Rules name a host and the beginning of a path; the longest fitting rule decides. URLs that
some rule decides are labelled URLs. Gradient-boosted trees (pyspark.ml) learn from at most
``sample`` distinct labelled URLs (lowest url hashes first) to judge the others by their
lexical features: lengths, depth, digit ratio, character entropy, parameter count, hyphens,
file ending, and statistics of the host's suffix (how often labelled URLs with that last
label were blocked, smoothed, and how common the suffix is). Everything is DataFrame expressions; nothing runs in Python workers.

Suffix statistics are one row per suffix, aggregated map-side, and joined back (Spark broadcasts
them when small and splits a hot suffix otherwise).

Defined results: a url that is null or has no ``://`` has an empty host and path, fits no
rule and is judged by the method like any other. If labelled URLs of only one verdict exist,
that verdict is the method's; with none it is ``allow``. Repeated rows are each returned; only
page_id and url are read.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tristar.session import write_stage

SAMPLE = 8000      # distinct labelled URLs to learn from at most
# Fixed values: (verdict, host, beginning of the path).
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
FEATURES = ["f_length", "f_host_length", "f_path_length", "f_depth", "f_labels", "f_digits",
            "f_entropy", "f_parameters", "f_hyphens", "f_ending", "f_fragment", "f_secure",
            "f_suffix_blocked", "f_suffix_common"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")),
                       _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def with_rule(urls: DataFrame, rules=RULES) -> DataFrame:
    """Adds host, path, rule and its verdict (null where no rule fits)."""
    urls = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # Shortest rules first, so that each longer one wraps (and wins over) them.
    for kind, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = (((F.col("host") == host) | F.col("host").endswith("." + host))
                & F.col("path").startswith(path))
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return urls.withColumns({"rule": rule, "ruled": verdict})


def with_features(urls: DataFrame, suffixes: DataFrame) -> DataFrame:
    """Adds the lexical features. ``suffixes``: suffix, blocked, labelled, common."""
    url = F.coalesce(F.col("url"), F.lit(""))
    size = F.greatest(F.length(url), F.lit(1))
    out = urls.withColumns({
        "chars": F.array_remove(F.split(F.regexp_replace(url, r"(?s)^.*?://", ""), ""), ""),
        "suffix": suffix_of(F.col("host"))})
    n = F.greatest(F.size("chars"), F.lit(1))
    # Entropy from the share of each distinct character: sum of -p * log2(p).
    entropy = F.aggregate(
        F.transform(F.array_distinct("chars"),
                    lambda c: F.size(F.filter("chars", lambda x: x == c)) / n),
        F.lit(0.0), lambda acc, p: acc - p * F.log2(p))
    out = out.join(suffixes, "suffix", "left").withColumns({
        "f_length": F.length(url), "f_host_length": F.length("host"),
        "f_path_length": F.length("path"),
        "f_depth": F.length("path") - F.length(F.replace(F.col("path"), F.lit("/"))),
        "f_labels": F.size(F.split("host", r"\.")),
        "f_digits": F.regexp_count(url, F.lit("[0-9]")) / size,
        "f_entropy": entropy,
        "f_parameters": F.regexp_count(url, F.lit(r"[?&][^=&#]+=")),
        "f_hyphens": F.regexp_count(url, F.lit("[-_]")),
        "f_ending": F.col("path").rlike(r"\.[a-z0-9]{1,5}$"),
        "f_fragment": F.contains(url, F.lit("#")), "f_secure": url.startswith("https:"),
        "f_suffix_blocked": (F.coalesce("blocked", F.lit(0)) + 1)
        / (F.coalesce("labelled", F.lit(0)) + 2),
        "f_suffix_common": F.log1p(F.coalesce("common", F.lit(0.0)))})
    return out.select(*urls.columns, *(F.col(f).cast("double").alias(f) for f in FEATURES))


def suffix_of(host: Column) -> Column:
    return F.regexp_extract(host, r"([^.]*)$", 1)


def suffix_statistics(ruled: DataFrame, all_urls: int) -> DataFrame:
    """Per host suffix: blocked and labelled URLs, and how many of a thousand URLs have it."""
    return (ruled.groupBy(suffix_of(F.col("host")).alias("suffix"))
            .agg(F.count(F.when(F.col("ruled") == "block", 1)).alias("blocked"),
                 F.count("ruled").alias("labelled"),
                 (F.count("*") * 1000.0 / max(all_urls, 1)).alias("common")))


def judge(pages: DataFrame, rules=RULES, sample: int = SAMPLE) -> DataFrame:
    """page_id, host, path, rule, verdict and the method's score of every url."""
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"))
    ruled = with_rule(urls, rules)
    counts = {r["ruled"]: r["count"] for r in ruled.groupBy("ruled").count().collect()}
    suffixes = write_stage(suffix_statistics(ruled, sum(counts.values())), "url-suffixes")
    full = with_features(ruled, suffixes)
    verdicts = sorted(k for k in counts if k)
    result = ["page_id", "host", "path", "rule", "verdict", "score"]
    if len(verdicts) < 2:
        only = verdicts[0] if verdicts else "allow"
        return full.withColumns({"verdict": F.coalesce("ruled", F.lit(only)),
                                 "score": F.lit(float(only == "block"))}).select(result)
    sampled = (ruled.filter("ruled IS NOT NULL").select("url", "host", "path", "ruled").distinct()
               .orderBy(F.xxhash64("url"), "url").limit(sample))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features")
    train = write_stage(vectors.transform(with_features(sampled, suffixes)).select(
        (F.col("ruled") == "block").cast("double").alias("label"), "features"), "url-sample")
    model = GBTClassifier(maxIter=12, maxDepth=4, stepSize=0.3, seed=1).fit(train)
    return model.transform(vectors.transform(full)).withColumns({
        "score": vector_to_array("probability")[1],
        "verdict": F.coalesce("ruled", F.when(F.col("prediction") == 1, "block")
                              .otherwise("allow"))}).select(result)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))
