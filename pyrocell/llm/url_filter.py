"""URL verdicts from pattern rules, with DataFrame functions only.

Every rule is filed under the rarest of its literal tokens (host labels, parts of labels, whole path segments), as
counted over the urls to be judged. A url's own tokens fetch the rules filed under them from a hash index that is part
of the expression, and only those rules' regular expressions run. Nothing is shuffled but the tokens' counts.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Up to so many rules the index is part of the plan and goes to every executor with it; more are joined on tokens.
MAX_RULES = 50_000


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, below ``path``; or, with ``word``, any host with that word in a label."""

    verdict: str
    host: str = ""
    path: str = "/"
    word: str = ""

    @property
    def text(self) -> str:
        return self.word or self.host + self.path

    @property
    def tokens(self) -> list[str]:
        if self.word:
            return [f"w:{self.word}"]
        return [f"h:{x}" for x in self.host.split(".")] + [f"p:{x}" for x in self.path.split("/")[1:-1]]

    @property
    def pattern(self) -> str:
        """For the site, that is host and path."""
        if self.word:
            return rf"^(?:[^/]*[.-])?{re.escape(self.word)}(?:[.-][^/]*)?(?:/|$)"
        return rf"^(?:[^/]*\.)?{re.escape(self.host)}{re.escape(self.path)}"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    host = lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(host: Column, path: Column) -> Column:
    labels, segments = F.split(host, r"\."), F.split(path, "/")
    whole = F.slice(segments, 2, F.greatest(F.size(segments) - 2, F.lit(0)))
    prefixed = lambda kind, xs: F.transform(xs, lambda x: F.concat(F.lit(kind), x))
    return F.array_distinct(F.concat(prefixed("h:", labels), prefixed("w:", F.split(host, r"[.-]")), prefixed("p:", whole)))


def token_counts(urls: DataFrame, tokens: list[str]) -> dict[str, int]:
    """How many urls have each of these tokens; as many rows reach the driver as the rules have tokens."""
    wanted = F.array(*[F.lit(t) for t in tokens])
    found = urls.select(F.explode(F.array_intersect(url_tokens(F.col("host"), F.col("path")), wanted)).alias("token"))
    return {r["token"]: r["n"] for r in found.groupBy("token").agg(F.count("*").alias("n")).collect()}


def best_by_join(sites: DataFrame, rules: list[Rule]) -> DataFrame:
    """(host, path, __best) of the distinct sites that some rule fits, for lists of any length: rules are filed under
    their rarest token by a join with the tokens' counts, and sites fetch them by another; only fetched rules' patterns
    run."""
    spark = sites.sparkSession
    wide = spark.createDataFrame([(k, r.tokens, 0 if r.word else len(r.text), None if r.word else r.text, r.verdict, r.pattern) for k, r in enumerate(rules)], "k int, tokens array<string>, size int, rule string, verdict string, pattern string")
    once = sites.select("host", "path").distinct()
    asked = once.withColumn("token", F.explode(url_tokens(F.col("host"), F.col("path"))))
    counts = asked.groupBy("token").agg(F.count("*").alias("n"))
    places = wide.select("k", F.explode("tokens").alias("token")).join(counts, "token", "left")
    rarest = places.groupBy("k").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("at")).select("k", F.col("at.token").alias("token"))
    filed = wide.drop("tokens").join(rarest, "k")
    fitting = asked.join(filed, "token").where(F.rlike(F.concat("host", "path"), F.col("pattern")))
    return fitting.groupBy("host", "path").agg(F.max(F.struct("size", "rule", "verdict")).alias("__best"))


def judge(df: DataFrame, rules: list[Rule], url_col: str = "url", otherwise: str = "allow", without_host: str = "block") -> DataFrame:
    """The rows with ``host``, ``path``, ``rule`` and ``verdict``; columns of these names are replaced.

    The longest host rule that fits wins (ties: the greater text, then the greater verdict) and is named in ``rule``.
    Where none fits, ``rule`` is null and the verdict is a word rule's (block before allow), else ``otherwise``, or
    ``without_host`` for urls that are null, have no ``://`` or an empty host. Repeated rows are judged one by one;
    an empty table gives an empty result.
    """
    host, path = parts(df[url_col])
    sites = df.withColumns({"host": host, "path": path})
    if not rules:
        return sites.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.when(F.col("host") == "", without_host).otherwise(otherwise)})
    verdict = F.coalesce(F.col("__best.verdict"), F.when(F.col("host") == "", without_host).otherwise(otherwise))
    if len(rules) > MAX_RULES:
        out = sites.join(best_by_join(sites, rules), ["host", "path"], "left").select(*sites.columns, "__best")
        return out.withColumns({"rule": F.col("__best.rule"), "verdict": verdict}).drop("__best")
    counts = token_counts(sites.select("host", "path"), sorted({t for r in rules for t in r.tokens}))
    filed: dict[str, list[dict]] = {}
    for r in rules:
        rarest = min(r.tokens, key=lambda t: (counts.get(t, 0), t))
        filed.setdefault(rarest, []).append({"token": rarest, "size": 0 if r.word else len(r.text), "rule": None if r.word else r.text, "verdict": r.verdict, "pattern": r.pattern})
    size = 1 << max(4, (2 * len(filed)).bit_length())
    slot = F.pmod(F.xxhash64("token"), F.lit(size)).cast("int")
    placed = df.sparkSession.createDataFrame([(t,) for t in filed], "token string").select("token", slot.alias("slot"))
    table: list[list[dict]] = [[] for _ in range(size)]
    for row in placed.collect():
        table[row["slot"]] += filed[row["token"]]
    index = F.from_json(F.lit(json.dumps(table)), "array<array<struct<token:string,size:int,rule:string,verdict:string,pattern:string>>>")
    site = F.concat("host", "path")
    fetched = F.flatten(F.transform(url_tokens(F.col("host"), F.col("path")), lambda t: F.filter(F.element_at(index, F.pmod(F.xxhash64(t), F.lit(size)).cast("int") + 1), lambda r: r["token"] == t)))
    fitting = F.filter(fetched, lambda r: F.rlike(site, r["pattern"]))
    best = F.array_max(F.transform(fitting, lambda r: F.struct(r["size"], r["rule"], r["verdict"])))
    out = sites.withColumn("__best", best)
    return out.withColumns({"rule": F.col("__best.rule"), "verdict": verdict}).drop("__best")


#: The rules of the registered query, and the method's own words for hosts that no rule covers.
SITE_RULES = [Rule("allow", "org"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/")]
BLOCKED_WORDS = ["ads", "adult", "bets", "casino", "pills", "porn", "spam", "track", "tracker", "xxx"]

ORACLE = """
WITH cut AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), site AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM site
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block'
  WHEN rule IS NOT NULL THEN 'allow'
  WHEN host = '' THEN 'block'
  WHEN regexp_matches(host, '(^|[.-])(ads|adult|bets|casino|pills|porn|spam|track|tracker|xxx)([.-]|$)') THEN 'block'
  ELSE 'allow' END AS verdict
FROM ruled
"""
