"""URL rules by host-suffix and path-prefix expressions (native)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower

#: Largest rule table that is broadcast; larger ones are joined by a shuffle.
BROADCAST_RULES = 200_000
#: Hex digits of the hash prefix that the join is on (32 bits).
PREFIX_DIGITS = 8


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    """Behind the host up to ``? #`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _directory(path_col: Column) -> Column:
    """A path up to its last slash: what the join can look up of a rule."""
    return F.regexp_extract(path_col, r"(?s)^(.*/)?", 1)


def _depth(path_col: Column) -> Column:
    return F.length(path_col) - F.length(F.replace(path_col, F.lit("/"), F.lit("")))


def expressions(host_col: Column, path_col: Column, labels: int, depth: int) -> Column:
    """Host suffixes of up to ``labels`` labels times path prefixes that end in
    one of the first ``depth`` slashes (and the empty prefix)."""
    parts = F.split(host_col, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))),
                           lambda n: F.array_join(F.slice(parts, -n, n), "."))
    steps = F.split(path_col, "/")
    prefixes = F.transform(F.sequence(F.lit(0), F.least(F.size(steps) - 1, F.lit(depth))),
                           lambda n: F.when(n == 0, F.lit("")).otherwise(
                               F.concat(F.array_join(F.slice(steps, 1, n), "/"), F.lit("/"))))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, F.lit(" "), p))))


def prepare_rules(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) with their join key.  Rows with a null are
    no rules; of equal (host, path) the smallest verdict counts."""
    rules = (rules.select(ascii_lower(F.col("host")).alias("r_host"), F.col("path").alias("r_path"), "verdict")
             .where("r_host is not null and r_path is not null and verdict is not null")
             .groupBy("r_host", "r_path").agg(F.min("verdict").alias("r_verdict")))
    expression = F.concat(F.col("r_host"), F.lit(" "), _directory(F.col("r_path")))
    return (rules.withColumn("r_digest", F.sha2(expression, 256))
            .withColumn("r_prefix", F.substring("r_digest", 1, PREFIX_DIGITS))
            .withColumn("r_labels", F.size(F.split("r_host", r"\.")))
            .withColumn("r_depth", _depth(F.col("r_path"))))


def url_filter(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow", salts: int = 16) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    A rule fits its host and all subdomains when the page's path starts with
    the rule's path; the longest rule wins (host and path together, then the
    longer host, then code points).  Without a fitting rule ``rule`` is null
    and the verdict is ``default``.  A null url or one without ``://`` has an
    empty host and path, which no rule fits unless it is empty itself.

    Repeated rows are judged once and come back as often as they came; a null
    id is an id like any other; an empty rule table leaves the default; other
    columns are ignored.  Hosts and paths are expanded as far as any rule
    reaches (two numbers, read from the rules), so nothing is cut off.  Rules
    above ``BROADCAST_RULES`` are joined by a shuffle, salted ``salts`` ways
    for hosts that hold a large part of the pages.
    """
    rules = prepare_rules(rules)
    n, labels, depth = rules.agg(F.count("*"), F.coalesce(F.max("r_labels"), F.lit(1)),
                                 F.coalesce(F.max("r_depth"), F.lit(0))).first()
    base = (pages.groupBy(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
            .agg(F.count("*").alias("copies"))
            .withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url"))))
    keys = base.withColumn("expression", F.explode(expressions(F.col("host"), F.col("path"), labels, depth)))
    keys = (keys.withColumn("digest", F.sha2("expression", 256))
            .withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS)))
    on = (F.col("prefix") == F.col("r_prefix"))
    if n <= BROADCAST_RULES:
        rules = F.broadcast(rules)
    else:
        keys = keys.withColumn("salt", F.pmod(F.hash("page_id", "url"), F.lit(salts)))
        rules = rules.withColumn("r_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        on = on & (F.col("salt") == F.col("r_salt"))
    on = on & (F.col("digest") == F.col("r_digest")) & F.startswith(F.col("path"), F.col("r_path"))
    found = F.when(F.col("r_host").isNotNull(), F.struct(
        (F.length("r_host") + F.length("r_path")).alias("size"), F.length("r_host").alias("host_size"),
        F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict")))
    best = (keys.join(rules, on, "left")
            .groupBy("page_id", "url", "copies", "host", "path").agg(F.max(found).alias("best")))
    return (best.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict")))
