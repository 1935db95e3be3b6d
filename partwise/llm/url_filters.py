"""URL rules by expanding each URL into host suffixes and path prefixes.

Every rule is known by the SHA-256 of its host and path. A URL is expanded only into suffixes with as
many labels, and prefixes of as many characters, as some rule has, so its number of expressions
follows the shapes of the rules and not the length of the URL. Expressions meet rules by equality of
the first hex digits of their digests; whole digests confirm.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rules that are surely small enough to be broadcast: their digests and texts are some tens of megabytes.
BROADCAST_RULES = 100_000
PREFIX_DIGITS = 8


def host_of(url: Column) -> Column:
    """What lies between the first :// and the next / ? # or the end, A-Z in lower case; else empty."""
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; else empty."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\.", -1))


def filter_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """(id_col, host, path, rule, verdict) for each row of pages, repeated rows and null ids included.

    rules has host, path and verdict. A rule fits its host and all subdomains where the URL's path
    starts with the rule's. The longest rule (host and path together) wins; of equally long ones that
    with the longer host; of equal ones `block`. Without a fitting rule, rule is null and the verdict
    the default. A null URL, or one without ://, has empty host and path, which only a rule with both
    empty fits. Whole URLs are looked at, however long. Other columns of pages are ignored; without pages the result is empty.
    """
    known = (
        rules.select(
            F.coalesce("host", F.lit("")).alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"), "verdict"
        )
        .groupBy("r_host", "r_path")
        .agg(F.max("verdict").alias("r_verdict"))  # block comes after allow
        .withColumn("digest", _digest(F.col("r_host"), F.col("r_path")))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
    )
    # pairs of small numbers, however many rules there are
    shapes = known.select(_labels(F.col("r_host")).alias("labels"), F.length("r_path").alias("chars")).distinct().collect()
    if known.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES:
        known = F.broadcast(known)

    urls = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        host_of(F.col(url_col)).alias("host"),
        path_of(F.col(url_col)).alias("path"),
    )
    labels = F.split("host", r"\.", -1)
    # one small constant, whatever the number of shapes: (labels, characters)
    listed = F.array(*[F.struct(F.lit(s["labels"]).alias("n"), F.lit(s["chars"]).alias("chars")) for s in shapes])
    fitting = F.filter(listed, lambda s: (F.size(labels) >= s["n"]) & (F.length("path") >= s["chars"]))
    found = F.transform(
        fitting,
        lambda s: _digest(F.array_join(F.slice(labels, -s["n"], s["n"]), "."), F.substring(F.col("path"), F.lit(1), s["chars"])),
    ) if shapes else F.array().cast("array<string>")
    expanded = urls.withColumn("e_digest", F.explode_outer(found))
    # the join key is the short prefix alone; the whole digest confirms what met
    met = expanded.withColumn("e_prefix", F.substring("e_digest", 1, PREFIX_DIGITS)).join(
        known, F.col("e_prefix") == F.col("prefix"), "left"
    )
    rule = F.concat("r_host", "r_path")
    best = F.max(
        F.when(
            F.col("digest") == F.col("e_digest"),
            F.struct(
                F.length(rule).alias("length"), F.length("r_host").alias("host_length"),
                F.col("r_verdict").alias("verdict"), rule.alias("rule"),
            ),
        )
    )
    judged = met.groupBy("row").agg(
        F.first("id").alias("id"), F.first("host").alias("host"), F.first("path").alias("path"), best.alias("best")
    )
    return judged.select(
        F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
