"""URL filters: rules are fetched by a literal token and only then run as patterns.

Each rule is filed under the one of its literal tokens that is rarest in the URLs at
hand. A URL's tokens fetch the rules filed under them by a join, and only these run
their regular expression on it. Rules without a token are filed under the empty
token, which every URL has.
"""

from __future__ import annotations

import re
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from casewatch.llm.common import checkpoint, local_table


@dataclass(frozen=True)
class SiteRule:
    """Fits a host and its subdomains where the path starts with `path`; longest wins."""

    action: str
    site: str  # host and path

    @property
    def pattern(self) -> str:
        host, slash, path = self.site.partition("/")
        return rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(slash + path)}"

    @property
    def tokens(self) -> list[str]:
        """Runs of letters and digits that end inside the rule: elsewhere a URL may go on."""
        return re.findall(r"[a-z0-9]+(?=[^A-Za-z0-9])", _lower(self.site))


@dataclass(frozen=True)
class PatternRule:
    """Blocks URLs in which `pattern` is found, unless a site rule fits.

    tokens: runs of letters and digits, lower case, that each URL with a match has between other characters.
    """

    pattern: str
    tokens: tuple[str, ...] = ()


# The site rules that the query applies.
SITE_RULES = (
    SiteRule("allow", "com/"),
    SiteRule("block", "example.com/en/"),
    SiteRule("allow", "www.example.com/en/"),
    SiteRule("block", "net/es/"),
    SiteRule("block", "net/fr/"),
)

# Patterns of addresses that are no articles, one for each literal.
PATTERN_RULES = (
    *(PatternRule(rf"(?i)[/.]{word}[/.]", (word,)) for word in ("ad", "ads", "adserver")),
    PatternRule(r"(?i)/login(?:[/?#]|$)", ("login",)),
    PatternRule(r"(?i)/cart(?:[/?#]|$)", ("cart",)),
    PatternRule(r"(?i)/cgi-bin/", ("cgi", "bin")),
    PatternRule(r"(?i)[?&]replytocom=", ("replytocom",)),
    *(PatternRule(rf"(?i)\.{word}(?:[?#]|$)", (word,)) for word in ("exe", "zip", "jpg", "png", "gif")),
)


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _lower(text: str) -> str:
    return text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host(url: Column) -> Column:
    """Between the first `://` and `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    """From the host's end up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(text: Column) -> Column:
    """Distinct lower-case runs of ASCII letters and digits, and the empty token."""
    runs = F.split(lower_ascii(F.coalesce(text, F.lit(""))), "[^a-z0-9]+")
    return F.array_distinct(F.array_append(runs, F.lit("")))


def _filed(
    spark: SparkSession, urls: DataFrame, sites: tuple[SiteRule, ...], patterns: tuple[PatternRule, ...]
) -> DataFrame:
    """The rules, each with the token it is filed under: its rarest in `urls`, ties by name.

    Only the counts of the rules' own tokens come to the driver, where the rules are
    anyway. As a local table their size is known, so Spark broadcasts them only if small.
    """
    rows = [("site", r.action, r.site, r.pattern, sorted(set(r.tokens))) for r in sites]
    rows += [("pattern", "block", None, r.pattern, sorted(set(r.tokens))) for r in patterns]
    own = local_table(spark, [(t,) for t in sorted({t for r in rows for t in r[-1]})], _texts("token"))
    seen = urls.select(F.explode(tokens(F.col("url"))).alias("token")).join(own, "token")
    count = {r.token: r.n for r in seen.groupBy("token").agg(F.count("*").alias("n")).collect()}
    filed = [(*r[:-1], min(r[-1], key=lambda t: (count.get(t, 0), t), default="")) for r in rows]
    return local_table(spark, filed, _texts("kind", "action", "site", "pattern", "token"))


def judge(
    pages: DataFrame,
    url: str = "url",
    key: str = "page_id",
    sites: tuple[SiteRule, ...] = SITE_RULES,
    patterns: tuple[PatternRule, ...] = PATTERN_RULES,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, and the pattern that blocked.

    The longest site rule that fits decides (of equally long ones a block, then by text).
    Without one, a URL with a pattern rule's match is blocked, any other allowed. Each
    different URL is judged once. A null URL or one without `://` has neither host nor
    path and no site rule. Null keys and repeated rows are kept. Only the two named
    columns are read.
    """
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"))
    urls = checkpoint(rows.filter("url is not null").groupBy("url").agg(F.count("*").alias("n")))
    address = urls.select("url", F.concat(host(F.col("url")), path(F.col("url"))).alias("place"))
    filed = _filed(pages.sparkSession, urls, sites, patterns)
    fetched = address.withColumn("token", F.explode(tokens(F.col("url")))).join(filed, "token")
    subject = F.when(F.col("kind") == "site", F.col("place")).otherwise(F.col("url"))
    fits = fetched.filter(F.rlike(subject, F.col("pattern")))
    rank = F.struct(
        F.length("site").alias("length"), (F.col("action") == "block").alias("block"), F.col("site").alias("rule"), "action"
    )
    decided = fits.groupBy("url", F.length("url").alias("width")).agg(
        F.max(F.when(F.col("kind") == "site", rank)).alias("best"),
        F.min(F.when(F.col("kind") == "pattern", F.col("pattern"))).alias("pattern"),
    )
    by_pattern = F.when(F.col("pattern").isNotNull(), "block").otherwise("allow")
    return rows.join(decided.drop("width"), "url", "left").select(
        "page_id",
        host(F.col("url")).alias("host"),
        path(F.col("url")).alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce("best.action", by_pattern).alias("verdict"),
        F.when(F.col("best").isNull(), F.col("pattern")).alias("blocking_pattern"),
    )
