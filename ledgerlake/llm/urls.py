"""URL filters: rules are indexed by their rarest literal token, and a URL tries the rules its own tokens fetch.

A rule is a regular expression over host and path, with the tokens (runs of a-z and 0-9) that every URL it fits must contain
whole. How many URLs hold each of these tokens is counted once, and a rule is filed under the one that the fewest hold. Rules
without such a token are filed under the empty token, which every URL has. Host rules fit their host and all subdomains if the
path begins with theirs; the longest one decides. Where none fits, pattern rules do: a URL is blocked if one fits, else allowed.

Defined results: a NULL url or one without ``://`` has empty host and path, and no rule fits it. Repeated rows are judged
alike. A NULL page_id is reported as NULL. An empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.shared import written

#: Larger rule sets are joined by shuffle.
BROADCAST_RULES = 100_000
_TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    verdict: str
    name: str
    pattern: str
    tokens: tuple[str, ...]
    is_host: bool


def host_rule(verdict: str, name: str) -> Rule:
    """``name``: host and the beginning of a path, such as ``example.org/en/1``."""
    whole = re.findall(_TOKEN + "(?=[^a-z0-9])", name.lower())
    host, slash, path = name.partition("/")
    return Rule(verdict, name, r"^(?:[^/]*\.)?" + re.escape(host.lower()) + re.escape(slash + path).replace(r"\-", "-"), tuple(whole), True)


def word_rule(verdict: str, word: str) -> Rule:
    """A word that stands in host or path between characters other than letters and digits."""
    return Rule(verdict, word, rf"(?i:(?:^|[^a-z0-9]){re.escape(word)}(?:$|[^a-z0-9]))", (word,), False)


HOST_RULES = (
    host_rule("allow", "org/"),
    host_rule("block", "example.org/es/"),
    host_rule("block", "example.org/en/1"),
    host_rule("allow", "com/fr/"),
    host_rule("block", "com/de/"),
)
WORD_RULES = tuple(word_rule("block", w) for w in ("adult", "bets", "betting", "casino", "gambling", "porn", "sex", "xxx"))
RULES = HOST_RULES + WORD_RULES


def parts(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case, and path."""
    url = F.coalesce(url, F.lit(""))
    shape = "(?s)^.*?://([^/?#]*)([^?#]*)"
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(url, shape, 1), capitals, capitals.lower()), F.regexp_extract(url, shape, 2)


def _tokens(site: str) -> Column:
    found = F.regexp_extract_all(F.lower(site), F.lit(_TOKEN), F.lit(0))
    return F.array_distinct(F.concat(found, F.array(F.lit(""))))


def rule_index(sites: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """The rules, each with the token it is filed under. What the driver sees is one count per token of a rule."""
    wanted = sorted({t for r in rules for t in r.tokens})
    tokens = sites.select(F.explode(_tokens("site")).alias("token")).where(F.col("token").isin(wanted))
    counts = {r["token"]: r["count"] for r in tokens.groupBy("token").count().collect()} if wanted else {}
    rows = [(min(r.tokens, key=lambda t: (counts.get(t, 0), t), default=""), r.pattern, r.verdict, r.name, r.is_host, len(r.name)) for r in rules]
    schema = "token string, pattern string, rule_verdict string, name string, is_host boolean, length int"
    return sites.sparkSession.createDataFrame(rows, schema)


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule (the host rule that decides), verdict, pattern (the pattern rule that decides)."""
    host, path = parts(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("site", F.concat("host", "path"))
    index = rule_index(split.select("site"), rules)
    side = F.broadcast(index) if len(rules) <= BROADCAST_RULES else index
    tried = split.select("site", F.explode(_tokens("site")).alias("token")).join(side, "token")
    fits = tried.where(F.regexp_like("site", F.col("pattern")))
    rank = F.struct("is_host", F.when(F.col("is_host"), F.col("length")).otherwise(0).alias("length"), (F.col("rule_verdict") == "block").alias("blocks"), "name", "rule_verdict")
    best = written(fits.groupBy("site").agg(F.max(rank).alias("best")).withColumnRenamed("site", "judged_site"))
    met = split.join(best, split.site == best.judged_site, "left")
    is_host = F.coalesce(F.col("best.is_host"), F.lit(False))
    return met.select(
        "page_id",
        "host",
        "path",
        F.when(is_host, F.col("best.name")).alias("rule"),
        F.coalesce("best.rule_verdict", F.lit("allow")).alias("verdict"),
        F.when(~is_host, F.col("best.name")).alias("pattern"),
    )


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def _words_sql() -> str:
    cases = (rf"CASE WHEN regexp_matches(site, '(^|[^A-Za-z0-9])(?i:{r.name})($|[^A-Za-z0-9])') THEN '{r.name}' END" for r in WORD_RULES)
    return reduce(lambda a, b: f"{a}, {b}", cases)


SQL = rf"""
WITH parts AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path
    FROM pages
), rules(verdict, h, p) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'),
        ('block', 'com', '/de/')
), sites AS (
    SELECT DISTINCT host, path, host || path AS site FROM parts
), best AS (
    SELECT host, path, h || p AS rule, verdict FROM sites JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
    QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(h || p) DESC) = 1
), words AS (
    SELECT host, path, greatest({_words_sql()}) AS word FROM sites
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN word IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
    CASE WHEN rule IS NULL THEN word END AS pattern
FROM parts LEFT JOIN best USING (host, path) LEFT JOIN words USING (host, path)
"""
