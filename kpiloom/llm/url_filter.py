"""URL rules found through their rarest literal token.

A rule is a pattern over ``host + path`` with ``*`` for any run of characters.
Patterns are compiled to regular expressions, but no URL meets all of them:
each rule is filed under the one of its literal tokens that is rarest among
the URLs at hand, each URL fetches the rules filed under its own tokens, and
only those run their expression.  A rule without a literal token is tried on
every URL.  DataFrame functions only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    """``pattern`` starts at the host or one of its parent domains and is open
    at its end (``net/``, ``example.net/en/``, ``spam-farm.``); with a leading
    ``*`` it starts anywhere.  Of the rules that fit, the highest ``rank`` wins,
    then the longest pattern, then the greatest in binary order."""

    pattern: str
    verdict: str
    rank: int = 1

    def expression(self) -> str:
        """Java regular expression over host + path."""
        parts = [re.sub(r"([^\w])", r"\\\1", p, flags=re.A) if p else "" for p in self.pattern.split("*")]
        start = "" if self.pattern.startswith("*") else "^(?:[^/]*\\.)?"
        return "(?s)" + start + ".*".join(parts)

    def tokens(self) -> list[str]:
        """Literal tokens that each URL of this rule must have as whole tokens:
        not those that touch a ``*`` or the open end."""
        found = []
        for m in re.finditer("[a-z0-9]+", self.pattern.translate(str.maketrans(UPPER, LOWER))):
            starts = m.start() == 0 or self.pattern[m.start() - 1] != "*"
            ends = m.end() < len(self.pattern) and self.pattern[m.end()] != "*"
            if starts and ends:
                found.append(m[0])
        return sorted(set(found))


#: Hosts that are blocked where no list says otherwise.
DEFAULT_BLOCKS = tuple(UrlRule(p, "block", 0) for p in (
    "spam-farm.", "cheap-pills.", "casino-win.", "free-bets.", "ads-track.", "adult-x.", "*/wp-login.php", "*/cgi-bin/"))


def rule_table(spark: SparkSession, rules: list[UrlRule]) -> DataFrame:
    rows = [F.struct(F.lit(i).alias("id"), F.lit(r.pattern).alias("rule"), F.lit(r.verdict).alias("rule_verdict"),
                     F.lit(r.rank).alias("rank"), F.lit(r.expression()).alias("expression"),
                     F.array(*[F.lit(t) for t in r.tokens()]).cast("array<string>").alias("tokens")) for i, r in enumerate(rules)]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def host_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    return F.when(at > 0, F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)).otherwise("")


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    return F.when(at > 0, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)).otherwise("")


def url_filter(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               otherwise: str = "allow") -> DataFrame:
    """Per row: ``page_id, host, path, rule, verdict, method_rule``.

    ``rule`` is the listed rule (rank 1) that decided, else null;
    ``method_rule`` the blocking pattern (rank 0) that decided, else null.
    Null urls and urls without ``://`` have empty host and path, fit only
    rules without tokens and get ``otherwise``.  Repeated rows are judged
    alike and stay repeated; an empty table gives an empty result; other
    columns are left out, so none can clash.

    Distinct host-and-path strings are judged once, so a page repeated a
    million times costs one look-up; the join back to the pages is split by
    Spark where one address is very frequent.
    """
    judged_pages = pages.select(F.col(id_col).alias("page_id"), host_of(F.coalesce(F.col(url_col), F.lit(""))).alias("host"),
                                path_of(F.coalesce(F.col(url_col), F.lit(""))).alias("path"))
    address = F.concat("host", "path")
    addresses = judged_pages.select(address.alias("address")).distinct()
    lower = F.translate("address", UPPER, LOWER)
    # the empty token leads to the rules that have no literal token
    tokens = addresses.select("address", F.explode(F.array_union(
        F.regexp_extract_all(lower, F.lit("[a-z0-9]+"), F.lit(0)), F.array(F.lit("")))).alias("token"))

    literal = rules.select("id", F.explode_outer("tokens").alias("token")).withColumn("token", F.coalesce("token", F.lit("")))
    wanted = literal.select("token").distinct()
    frequency = tokens.join(wanted, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    filed = (literal.join(frequency, "token", "left")
             .groupBy("id").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token")))
    index = filed.join(rules.drop("tokens"), "id")

    fits = (tokens.join(index, "token").where(F.regexp_like("address", F.col("expression")))
            .groupBy("address").agg(F.max(F.struct("rank", F.length("rule").alias("length"), "rule", "rule_verdict")).alias("best")))
    listed = F.col("best.rank") > 0
    return (judged_pages.withColumn("address", address).join(fits, "address", "left")
            .select("page_id", "host", "path", F.when(listed, F.col("best.rule")).alias("rule"),
                    F.coalesce(F.col("best.rule_verdict"), F.lit(otherwise)).alias("verdict"),
                    F.when(~listed, F.col("best.rule")).alias("method_rule")))
