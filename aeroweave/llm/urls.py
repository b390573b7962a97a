"""URL filters: host-suffix and path-prefix expressions joined with rules on short digest prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroweave.llm.shared import broadcast_if_small

#: Rules of about 150 bytes each that may be broadcast.
BROADCAST_RULES = 100_000
#: Path lengths of rules that are written into the plan; more are joined.
LISTED_LENGTHS = 1_000
SALTS = 32


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' without ``://``."""
    rest = _after_scheme(url)
    return F.translate(
        F.coalesce(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), F.lit("")),
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end; '' without ``://``."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def filter_urls(
    pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url", default: str = "allow",
) -> DataFrame:
    """Judge every row of ``pages`` by the longest rule that fits its URL.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block). A rule fits its host and the host's
    subdomains when the URL's path starts with the rule's path. Of several that fit, the one with the longest
    text wins, then the longer host, then block. Without one, ``rule`` is null and the verdict ``default``.

    Each distinct (host, path) is expanded into its host suffixes times its path prefixes of the lengths that rules
    have; expressions meet rules on the first eight hex digits of their SHA-256, and the full digest confirms. The
    rules are broadcast only when counted to be few; else they are repeated over salts, so that an expression which
    a third of all URLs share is split.

    Returns the id, host, path, rule and verdict. A null URL, or one without ``://``, has an empty host and path and
    no rule. Rows with a null rule field are no rules; repeated rows, null ids and other columns of ``pages`` do no harm.
    """
    judged = pages.select(F.col(id_column).alias("id"), F.col(url_column).cast("string").alias("url"))
    judged = judged.select("id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    rules = rules.select(*(F.col(c).cast("string").alias(c) for c in ("host", "path", "verdict"))).dropna()
    rules = rules.select(
        F.concat("host", "path").alias("rule"), F.length("host").alias("host_length"), F.length("path").alias("n"),
        "verdict", F.sha2(F.concat_ws("\n", "host", "path"), 256).alias("rule_digest"))
    lengths = rules.select("n").distinct()
    listed = [row.n for row in lengths.limit(LISTED_LENGTHS + 1).collect()]

    parts = F.split(F.col("host"), r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    addresses = judged.select("host", "path").filter(F.col("host") != "").distinct()
    if len(listed) <= LISTED_LENGTHS:
        fitting = F.filter(F.array(*[F.lit(n) for n in listed]).cast("array<int>"), lambda n: n <= F.length("path"))
        sized = addresses.withColumn("n", F.explode(fitting))
    else:
        # every length of a path, of which those remain that a rule has
        sized = addresses.withColumn("n", F.explode(F.sequence(F.lit(0), F.length("path")))).join(broadcast_if_small(lengths), "n", "left_semi")
    expressions = (
        sized.withColumn("prefix", F.col("path").substr(F.lit(1), F.col("n"))).withColumn("suffix", F.explode(suffixes))
        .select("host", "path", F.sha2(F.concat_ws("\n", "suffix", "prefix"), 256).alias("digest"))
        .withColumn("short", F.substring("digest", 1, 8)))
    rules = rules.withColumn("rule_short", F.substring("rule_digest", 1, 8))
    if rules.count() <= BROADCAST_RULES:
        matched = expressions.join(F.broadcast(rules), F.col("short") == F.col("rule_short"))
    else:
        rules = rules.withColumn("rule_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        expressions = expressions.withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int"))
        matched = expressions.join(
            rules, (F.col("short") == F.col("rule_short")) & (F.col("salt") == F.col("rule_salt")))
    best = (
        matched.filter(F.col("digest") == F.col("rule_digest"))
        .groupBy(F.col("host").alias("best_host"), F.col("path").alias("best_path"))
        .agg(F.max(F.struct(
            F.length("rule").alias("length"), F.col("host_length"), F.col("verdict"), F.col("rule"))).alias("best")))
    return judged.join(best, (F.col("host") == F.col("best_host")) & (F.col("path") == F.col("best_path")), "left").select(
        F.col("id").alias(id_column), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"))
