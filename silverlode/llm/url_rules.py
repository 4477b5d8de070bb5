"""URL filter lists: host-suffix and path-prefix expressions joined on short hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import lower_ascii

# Hexadecimal digits of the short hash that the join uses; the full digest confirms.
PREFIX_DIGITS = 8


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty for null or without ``://``."""
    text = F.coalesce(url, F.lit(""))
    mark = F.locate("://", text)
    rest = F.when(mark > 0, F.substring(text, mark + 3, F.length(text))).otherwise("")
    host = lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0))
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return host, path


def _directory(path: Column) -> Column:
    """A path up to its last slash; the rest of a rule's path is compared after the join."""
    return F.regexp_extract(path, "(?s)^.*/", 0)


def _expression(host: Column, directory: Column) -> Column:
    return F.concat(host, F.lit("\n"), directory)


def host_suffixes(host: Column, most: int) -> Column:
    """The last 1, 2, ... labels of a host, up to ``most`` labels."""
    labels = F.split(host, "\\.")
    depths = F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most)))
    return F.transform(depths, lambda k: F.array_join(F.slice(labels, -k, k), "."))


def path_prefixes(path: Column, most: int) -> Column:
    """The empty prefix and those that end with the 1st, 2nd, ... slash, up to ``most`` slashes."""
    parts = F.split(path, "/")
    depths = F.sequence(F.lit(0), F.least(F.size(parts) - 1, F.lit(most)))
    return F.transform(
        depths, lambda k: F.when(k == 0, "").otherwise(F.concat(F.array_join(F.slice(parts, 1, k), "/"), F.lit("/")))
    )


def judge_urls(pages: DataFrame, rules: DataFrame, otherwise: str = "allow", id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """Verdict of the longest fitting rule for each row of ``pages``.

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and all
    subdomains where the path of the URL starts with the path of the rule. The
    longest ``host + path`` wins, then the longer host; of one rule with two
    verdicts ``block`` wins. Rows without a fitting rule get ``otherwise`` and a
    null rule. Null URLs and URLs without ``://`` have an empty host and path;
    repeated rows are judged each; other columns of ``pages`` are left out.

    URLs are first reduced to distinct pairs of host and path head (no longer than
    the longest rule path), so a host that owns a third of the rows is expanded
    once per head. No pair is expanded deeper than the deepest rule.
    """
    host, path = url_parts(F.col(url_column))
    deepest = rules.agg(
        F.coalesce(F.max(F.size(F.split("host", "\\."))), F.lit(1)).alias("labels"),
        F.coalesce(F.max(F.size(F.split(_directory(F.col("path")), "/")) - 1), F.lit(0)).alias("slashes"),
        F.coalesce(F.max(F.length("path")), F.lit(0)).alias("length"),
    ).first()
    urls = pages.select(F.col(id_column), host.alias("host"), path.alias("path"))
    urls = urls.withColumn("head", F.substring("path", 1, deepest["length"]))

    keys = urls.select("host", "head").distinct()
    expanded = (
        keys.withColumn("suffix", F.explode(host_suffixes(F.col("host"), deepest["labels"])))
        .withColumn("directory", F.explode(path_prefixes(F.col("head"), deepest["slashes"])))
        .withColumn("digest", F.sha2(_expression(F.col("suffix"), F.col("directory")), 256))
        .select("host", "head", "digest", F.substring("digest", 1, PREFIX_DIGITS).alias("short"))
    )
    listed = rules.select(
        F.concat("host", "path").alias("rule"),
        F.col("path").alias("rule_path"),
        F.length("host").alias("host_length"),
        "verdict",
        F.sha2(_expression(F.col("host"), _directory(F.col("path"))), 256).alias("rule_digest"),
    ).withColumn("short", F.substring("rule_digest", 1, PREFIX_DIGITS))
    fitting = expanded.join(listed, "short").filter(
        (F.col("digest") == F.col("rule_digest")) & F.startswith("head", "rule_path")
    )
    order = F.struct(F.length("rule"), "host_length", F.col("verdict") == "block")
    best = fitting.groupBy("host", "head").agg(F.max_by(F.struct("rule", "verdict"), order).alias("best"))
    return urls.join(best, ["host", "head"], "left").select(
        F.col(id_column),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"),
    )
