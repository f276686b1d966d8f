"""URL filtering: expand, join on short hash prefixes, confirm, take the longest rule.

A URL is expanded into every pair of a host suffix and a path prefix that could
be a rule: only suffixes of as many labels, and prefixes of as many characters,
as some rule has. The expressions meet the rules in an equi-join on the first
digits of their SHA-256; the whole digests are then compared, and of the rules
that fit a URL the longest wins. All of it is built-in functions.

Defined results: a null URL, or one without ``://``, has an empty host and path;
repeated rows are judged each; an empty rule table leaves every URL to the
default; of two rules with one host and path the blocking one counts. A URL of any
length is judged whole; only its column and the id are read, whatever others there are.
An empty table of pages gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waferlens.llm.common import join_bounded, staged

PREFIX_DIGITS = 8
# Blocked network, and the exceptions within it: host, path prefix, verdict.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, in small letters."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, CAPITALS, SMALL), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path).cast("binary"), 256)


def judge(
    pages: DataFrame,
    rules: DataFrame,
    url_column: str = "url",
    keep: tuple[str, ...] = ("page_id",),
    default: str = "allow",
    prefix_digits: int = PREFIX_DIGITS,
    **bounds,
) -> DataFrame:
    """The ``keep`` columns with host, path, rule and verdict of each row."""
    digest = _digest(F.col("_rule_host"), F.col("_rule_path"))
    known = staged(
        rules.groupBy(F.col("host").alias("_rule_host"), F.col("path").alias("_rule_path"))
        # "block" sorts after "allow"
        .agg(F.max("verdict").alias("_verdict"))
        .withColumn("_digest", digest)
        .withColumn("_prefix", F.substring("_digest", 1, prefix_digits)),
        "url-rules",
    )
    # At most as many numbers as a host has labels, and a path characters.
    shape = known.agg(
        F.sort_array(F.collect_set(F.size(F.split("_rule_host", r"\.", -1)))),
        F.sort_array(F.collect_set(F.char_length("_rule_path"))),
    ).first()
    labels, lengths = (list(numbers) for numbers in shape)

    kept = [F.col(name).alias(f"_keep{i}") for i, name in enumerate(keep)]
    urls = pages.select(
        *kept, url_host(F.col(url_column)).alias("_host"), url_path(F.col(url_column)).alias("_path")
    ).withColumn("_row", F.monotonically_increasing_id())

    parts = F.split("_host", r"\.", -1)
    suffixes = [
        F.when(F.size(parts) >= n, F.array_join(F.slice(parts, -n, n), ".")) for n in labels
    ]
    prefixes = [
        F.when(F.char_length("_path") >= n, F.substring(F.col("_path"), 1, n)) for n in lengths
    ]
    pairs = [
        F.when(s.isNotNull() & p.isNotNull(), F.struct(s.alias("host"), p.alias("path")))
        for s in suffixes
        for p in prefixes
    ]
    expressions = F.array_compact(F.array(*pairs)) if pairs else F.array().cast(
        "array<struct<host:string,path:string>>"
    )
    expanded = urls.withColumn("_expression", F.explode_outer(expressions)).withColumn(
        "_full", _digest(F.col("_expression.host"), F.col("_expression.path"))
    )
    found = join_bounded(
        expanded.withColumn("_short", F.substring("_full", 1, prefix_digits)),
        staged_groups(known),
        ["_short"],
        "left",
        **bounds,
    )
    confirmed = F.get(F.filter("_rules", lambda rule: rule["digest"] == F.col("_full")), F.lit(0))
    # The longest rule wins; of equally long ones that with the longer host.
    length = F.char_length(F.concat(confirmed["host"], confirmed["path"]))
    best = F.max(
        F.when(
            confirmed.isNotNull(),
            F.struct(
                length.alias("length"),
                F.char_length(confirmed["host"]).alias("host_length"),
                F.concat(confirmed["host"], confirmed["path"]).alias("rule"),
                confirmed["verdict"].alias("verdict"),
            ),
        )
    )
    names = [f"_keep{i}" for i in range(len(keep))]
    return (
        found.groupBy("_row")
        .agg(*(F.first(name).alias(name) for name in [*names, "_host", "_path"]), best.alias("_best"))
        .select(
            *(F.col(name).alias(wanted) for name, wanted in zip(names, keep, strict=True)),
            F.col("_host").alias("host"),
            F.col("_path").alias("path"),
            F.col("_best.rule").alias("rule"),
            F.coalesce(F.col("_best.verdict"), F.lit(default)).alias("verdict"),
        )
    )


def staged_groups(known: DataFrame) -> DataFrame:
    """One row for each hash prefix with the rules under it: few, as digests are even."""
    return known.groupBy(F.col("_prefix").alias("_short")).agg(
        F.collect_list(
            F.struct(
                F.col("_digest").alias("digest"),
                F.col("_rule_host").alias("host"),
                F.col("_rule_path").alias("path"),
                F.col("_verdict").alias("verdict"),
            )
        ).alias("_rules")
    )


SQL = """
with u as (
    select page_id,
        coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
    from pages
),
r(rule_host, rule_path, verdict) as (
    values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
)
select page_id, host, path,
    (select rule_host || rule_path from r
        where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
        order by length(rule_host || rule_path) desc limit 1) as rule,
    coalesce((select verdict from r
        where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
        order by length(rule_host || rule_path) desc limit 1), 'allow') as verdict
from u
"""
