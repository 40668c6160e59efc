"""URL filters with an index by the rarest literal token.

A rule is a regular expression over ``host + path`` with the literal tokens
(runs of ASCII letters and digits) every match must hold as whole tokens. How
many URLs hold each of these tokens is counted over the table; a rule is filed
under its rarest one. A URL's own tokens fetch the rules filed under them, and
only those run their expression. All in DataFrame functions; the count is one
aggregate with a row per rule token.

Up to ``LITERAL_RULES`` rules are a constant of the plan: one scan, no shuffle.
More are a table: the tokens of each distinct URL meet the rules filed under them
in a join, which Spark chooses by the table's size, and the hits go back to the
rows by URL. Both ways give the same result.

Two lists share the index. Path rules (host, path) fit a host and its subdomains
if the path starts with theirs; the longest that fits decides. Pattern rules
speak only where no path rule fits: a URL with a hit is blocked, any other is
allowed.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end,
A-Z lower-cased; the path goes on from there up to ``?``, ``#`` or the end.

Defined cases: a null URL or one without ``://`` has an empty host and path, so
no rule fits and it is allowed; repeated rows are judged each; an empty table
gives an empty result; a rule without any token is tried on every URL.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import table


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    pattern: str  # over host + path
    tokens: tuple[str, ...]  # each is a whole token of every match
    length: int = 0  # the longest path rule wins; 0 for pattern rules


_TOKEN = r"[A-Za-z0-9]+"
LITERAL_RULES = 64


def path_rule(verdict: str, rule: str) -> Rule:
    """``rule`` is host and path in one, like ``example.org/en/1``."""
    host, slash, path = rule.partition("/")
    path = slash + path
    tokens = re.findall(_TOKEN, host)
    # The rule's last path token may be the beginning of a longer one.
    tokens += [m[0] for m in re.finditer(_TOKEN, path) if m.end() < len(path)]
    return Rule(rule, verdict, rf"^(?:[^/]*\.)?{_quote(host)}{_quote(path)}", tuple(dict.fromkeys(tokens)), len(rule))


def word_rule(words: str) -> Rule:
    """Blocks hosts that hold the hyphenated ``words`` as whole words."""
    return Rule(words, "block", rf"^(?:[^/]*[.-])?{_quote(words)}(?:[.-][^/]*)?(?:/|$)", tuple(re.findall(_TOKEN, words)))


def _quote(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)


PATH_RULES = (
    path_rule("allow", "org/"), path_rule("block", "example.org/es/"), path_rule("block", "example.org/en/1"),
    path_rule("allow", "com/fr/"), path_rule("block", "com/de/"),
)
PATTERN_RULES = tuple(word_rule(w) for w in ("spam-farm", "cheap-pills", "casino-win", "free-bets", "ads-track", "casino", "xxx", "porn"))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    place = F.regexp_extract(rest, r"(?s)^([^?#]*)", 1)
    host = F.substring_index(place, "/", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), F.substring(place, F.char_length(host) + 1, F.char_length(place))


def _tokens(place: Column) -> Column:
    return F.array_distinct(F.split(place, r"[^A-Za-z0-9]+"))


def _wanted(rules: tuple[Rule, ...]) -> list[str]:
    return sorted({t for r in rules for t in r.tokens})


def token_counts(places: DataFrame, rules: tuple[Rule, ...]) -> dict[str, int]:
    """In how many rows (place) each token of a rule is."""
    wanted = _wanted(rules)
    if not wanted:
        return {}
    if len(rules) <= LITERAL_RULES:
        held = F.array_intersect(_tokens(F.col("place")), F.array(*map(F.lit, wanted)))
        tokens = places.select(F.explode(held).alias("token"))
    else:
        asked = places.sparkSession.createDataFrame([(t,) for t in wanted], "token string")
        tokens = places.select(F.explode(_tokens(F.col("place"))).alias("token")).join(asked, "token", "left_semi")
    found = tokens.groupBy("token").agg(F.count("*").alias("n")).collect()
    return dict.fromkeys(wanted, 0) | {r["token"]: r["n"] for r in found}


def index_of(rules: tuple[Rule, ...], counts: dict[str, int]) -> dict[str, list[Rule]]:
    """Rules by their rarest token; "" has the rules without one."""
    found: dict[str, list[Rule]] = {}
    for r in rules:
        found.setdefault(min(r.tokens, key=lambda t: (counts[t], t), default=""), []).append(r)
    return found


def _hits(place: Column, index: dict[str, list[Rule]]) -> Column:
    """Rules that fit, as an array of structs."""
    as_struct = lambda r: F.struct(
        F.lit(r.length).alias("length"), F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"), F.lit(r.pattern).alias("pattern"))
    if not index:
        return F.array().cast("array<struct<length:int,name:string,verdict:string,pattern:string>>")
    filed = F.create_map(*[x for t, rs in index.items() for x in (F.lit(t), F.array(*map(as_struct, rs)))])
    asked = F.array_intersect(F.array_append(_tokens(place), F.lit("")), F.array(*map(F.lit, index)))
    candidates = F.flatten(F.transform(asked, lambda t: F.element_at(filed, t)))
    return F.filter(candidates, lambda r: F.rlike(place, r["pattern"]))


def _with_hits_by_table(places: DataFrame, index: dict[str, list[Rule]]) -> DataFrame:
    """``places`` with the rules that fit, found by a join with the index as a table."""
    rows = [(t, r.length, r.name, r.verdict, r.pattern) for t, rs in index.items() for r in rs]
    filed = places.sparkSession.createDataFrame(rows, "token string, length int, name string, verdict string, pattern string")
    # Equal URLs are one before the join: combined in tasks, so a frequent one is no hot key.
    tokens = places.select("place").distinct().select("place", F.explode(F.array_append(_tokens(F.col("place")), F.lit(""))).alias("token"))
    fits = tokens.distinct().join(filed, "token").where(F.rlike("place", F.col("pattern")))
    hits = fits.groupBy("place").agg(F.collect_list(F.struct("length", "name", "verdict", "pattern")).alias("all"))
    none = F.array().cast("array<struct<length:int,name:string,verdict:string,pattern:string>>")
    return places.join(hits, "place", "left").withColumn("all", F.coalesce("all", none))


def judge(pages: DataFrame, path_rules: tuple[Rule, ...] = PATH_RULES, pattern_rules: tuple[Rule, ...] = PATTERN_RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, hits) of ``pages`` (page_id, url);
    hits names the pattern rules that fit."""
    host, path = split_url(F.col("url"))
    places = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("place", F.concat("host", "path"))
    rules = path_rules + pattern_rules
    index = index_of(rules, token_counts(places, rules))
    judged = places.withColumn("all", _hits(F.col("place"), index)) if len(rules) <= LITERAL_RULES else _with_hits_by_table(places, index)
    best = F.try_element_at(F.reverse(F.array_sort(F.filter("all", lambda r: r["length"] > 0))), F.lit(1))
    named = F.array_sort(F.transform(F.filter("all", lambda r: r["length"] == 0), lambda r: r["name"]))
    return judged.withColumn("best", best).withColumn("hits", named).select(
        "page_id", "host", "path", F.col("best.name").alias("rule"),
        F.coalesce("best.verdict", F.when(F.size("hits") > 0, "block").otherwise("allow")).alias("verdict"), "hits",
    )


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages", "page_id", "url")).drop("hits")


def _sql() -> str:
    rules = ", ".join(f"('{r.name.partition('/')[0]}', '/{r.name.partition('/')[2]}', '{r.name}', '{r.verdict}')" for r in PATH_RULES)
    words = "|".join(r.name for r in PATTERN_RULES)
    return f"""
WITH cut AS (SELECT page_id, coalesce(CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END, '') AS rest FROM pages),
places AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS h, regexp_extract(rest, '^[^?#]*') AS place FROM cut),
urls AS (SELECT row_number() OVER () AS row, page_id, lower(h) AS host, substr(place, length(h) + 1) AS path FROM places),
rules(h, p, name, verdict) AS (VALUES {rules}),
fits AS (
  SELECT u.*, r.name, r.verdict, row_number() OVER (PARTITION BY row ORDER BY length(r.name) DESC NULLS LAST) AS k
  FROM urls u LEFT JOIN rules r ON (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.p))
SELECT page_id, host, path, name AS rule, coalesce(verdict, CASE WHEN regexp_matches(host, '(^|[.-])({words})([.-]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM fits WHERE k = 1"""


QUERIES = {"op3_url_filters": op3_url_filters}
ORACLE = {"op3_url_filters": _sql()}
