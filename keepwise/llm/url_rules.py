"""URL rules, indexed by their rarest literal token.

Every rule is a regular expression over host + path with literal tokens that
any match must contain. The tokens' counts over all URLs pick each rule's
rarest one; rules are a table, joined to the URLs' tokens by it, and only the rules so fetched run.
Two kinds of rules share the index: list rules (host suffix and path prefix,
longest wins) and pattern rules, which decide where no list rule fits.
"""
from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwise.llm.common import saved

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_TOKEN = r"[^A-Za-z0-9\x{80}-\x{10FFFF}]+"

# (verdict, host, path)
LIST_RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
              ("allow", "com", "/fr/"), ("block", "com", "/de/"))
# (name, pattern on host + path, literal tokens)
PATTERN_RULES = (
    ("spam", r"^[^/]*(?<![a-z0-9])spam(?![a-z0-9])", ("spam",)),
    ("adult", r"^[^/]*(?<![a-z0-9])adult(?![a-z0-9])", ("adult",)),
    ("casino", r"^[^/]*(?<![a-z0-9])casino(?![a-z0-9])", ("casino",)),
    ("bets", r"^[^/]*(?<![a-z0-9])free-bets(?![a-z0-9])", ("free", "bets")),
    ("pills", r"^[^/]*(?<![a-z0-9])cheap-pills(?![a-z0-9])", ("cheap", "pills")),
    ("tracker", r"^[^/]*(?<![a-z0-9])ads-track(?![a-z0-9])", ("ads", "track")),
)


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path); null and URLs without '://' give two empty strings."""
    after = F.when(F.locate("://", url) > 0, url.substr(F.locate("://", url) + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def _list_rule(host: str, path: str) -> tuple[str, tuple[str, ...]]:
    """Pattern and literal tokens of a list rule; the last token of the path counts only where it is closed."""
    tokens = re.split(r"[^A-Za-z0-9\x80-\U0010ffff]+", host + path)
    if re.search(r"[A-Za-z0-9\x80-\U0010ffff]$", path):
        tokens = tokens[:-1]
    return rf"^(?:[^/]*\.)?\Q{host}{path}\E", tuple(t for t in tokens if t)


_RULE = "number long, kind string, verdict string, name string, pattern string, length int, tokens array<string>"
_SALTS = 8


def rule_table(spark: SparkSession, list_rules: Sequence[tuple[str, str, str]] = LIST_RULES,
               pattern_rules: Sequence[tuple[str, str, tuple[str, ...]]] = PATTERN_RULES) -> DataFrame:
    """number, kind, verdict, name, pattern, length, tokens: the rules as a table; each has at least one literal token."""
    rows = [("list", verdict, host + path, *_list_rule(host, path)) for verdict, host, path in list_rules]
    rows += [("pattern", "block", name, pattern, tuple(tokens)) for name, pattern, tokens in pattern_rules]
    if loose := [r[2] for r in rows if not r[4]]:
        raise ValueError(f"rules without a literal token: {loose}")
    return spark.createDataFrame([(i, kind, verdict, name, pattern, len(name), list(tokens)) for i, (kind, verdict, name, pattern, tokens) in enumerate(rows)], _RULE)


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: DataFrame | None = None) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, patterns, verdict.

    ``rules`` is a ``rule_table`` (default: the fixed rules), of any size: each rule is joined to the URLs by its rarest
    token, and its pattern runs on those URLs alone; token counts come from all URLs.
    ``rule`` is the longest list rule that fits (null: none; ties: by name, then verdict) and gives the
    verdict; without one, any matching pattern rule blocks and the rest is
    allowed. Null, empty and malformed URLs have empty host and path, fit nothing
    and are allowed; long ones are read whole. Repeated rows repeat; a null page_id keeps its row;
    other columns are ignored; an empty table gives an empty table.
    """
    rules = rule_table(pages.sparkSession) if rules is None else rules
    host, path = split_url(F.col(url_col).cast("string"))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    urls = saved(urls.withColumn("row", F.monotonically_increasing_id()), "urls")           # written: row numbers stay
    address = F.concat("host", "path")
    tokens = urls.select("row", F.explode(F.array_distinct(F.split(address, _NO_TOKEN))).alias("token")).filter("token != ''")

    literal = rules.select("number", F.explode("tokens").alias("token"))
    counts = tokens.join(literal.select("token").distinct(), "token", "left_semi").groupBy("token").count()
    rarest = (literal.join(counts, "token", "left").groupBy("number")
              .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "token")).alias("rarest"))
              .select("number", F.col("rarest.token").alias("token")))
    index = rules.join(rarest, "number").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_SALTS - 1).cast("long"))))
    # a frequent token's URLs are dealt out by salt
    fetched = tokens.withColumn("_salt", F.pmod(F.xxhash64("row"), F.lit(_SALTS))).join(index, ["token", "_salt"])
    matched = (fetched.select("row", "kind", "verdict", "name", "pattern", "length").join(urls.select("row", address.alias("address")), "row")
               .filter(F.regexp(F.col("address"), F.col("pattern"))))
    best = F.min(F.when(F.col("kind") == "list", F.struct(F.negative("length").alias("shorter"), "name", "verdict"))).alias("best")
    per_row = matched.groupBy("row").agg(best, F.array_sort(F.collect_set(F.when(F.col("kind") == "pattern", F.col("name")))).alias("names"),
                                         F.max(F.when(F.col("kind") == "pattern", F.lit(True))).alias("caught"))
    verdict = F.when(F.col("best").isNotNull(), F.col("best.verdict")).when(F.col("caught"), "block").otherwise("allow")
    return urls.join(per_row, "row", "left").select("page_id", "host", "path", F.col("best.name").alias("rule"),
                                                    F.concat_ws(",", "names").alias("patterns"), verdict.alias("verdict"))
