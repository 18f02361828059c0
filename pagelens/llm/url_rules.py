"""URL filters: pattern rules are fetched by their rarest literal token, and only those run regular expressions.

A rule is a host, a path and a verdict; it fits its host and all subdomains of it where
the URL's path starts with the rule's. ``*`` in either part stands for any characters
(in the host: any but ``/``); an empty host is any host. Of the rules that fit a URL the
one with the longest text (host and path together) wins, of equally long ones a ``block``
rule before others, then the text that sorts last.

Every rule is indexed by one token only: of the tokens that each fitting URL must hold
whole, the one that the fewest URLs hold. A URL's own tokens then fetch the few rules whose
regular expressions are worth running; rules without such a token are fetched by all URLs.

Up to INDEX_RULES rules (counted first) the index travels as one value and URLs are
judged where they are read: nothing is shuffled but token counts. More rules are met by a
join on the token, over distinct URLs, salted, so that a token of a third of all URLs is
no task of its own. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelens.llm.common import free, lower_ascii, prepare, table

#: Rules that travel as one index (under 10 MB at 200 bytes a rule with its pattern).
INDEX_RULES = 20_000
#: Slots of the index, each a short list; shares of a token's URLs in the join.
SLOTS, SALTS = 4096, 16

#: A character of a token: a letter, a digit or anything beyond ASCII.
_T = r"0-9A-Za-z\x{80}-\x{10FFFF}"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): the host follows the first ``://``, A-Z lower-cased, up to ``/``, ``?``, ``#`` or the end; the
    path goes on up to ``?``, ``#`` or the end. A null URL or one without ``://`` has two empty parts."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return (lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def _tagged(tokens: Column, tag: str) -> Column:
    return F.transform(tokens, lambda t: F.concat(F.lit(tag), t))


def url_tokens(host: Column, path: Column) -> Column:
    """Distinct tokens of a URL, those of the host apart from those of the path, and the empty token that all URLs hold."""
    run = F.lit(f"([{_T}]+)")
    return F.array_distinct(F.concat(_tagged(F.regexp_extract_all(host, run), "h:"), _tagged(F.regexp_extract_all(path, run), "p:"), F.array(F.lit(""))))


def _literal(text: Column, wild: str) -> Column:
    """A regular expression for the text, ``*`` being ``wild``."""
    safe = F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q"))
    return F.concat(F.lit(r"\Q"), F.replace(safe, F.lit("*"), F.lit(rf"\E{wild}\Q")), F.lit(r"\E"))


def compiled(rules: DataFrame) -> DataFrame:
    """``_rule, _verdict, _pattern, _tokens`` of each rule; the pattern is for host and path joined.

    Tokens are those that stand whole in each fitting URL: none beside a ``*``, and none at
    the end of the path, where a URL may go on. Repeated rules are one; rules without a verdict take no part.
    """
    host, path = lower_ascii(F.coalesce("host", F.lit(""))), F.coalesce("path", F.lit(""))
    fits = F.when(host == "", F.lit("^[^/]*")).otherwise(F.concat(F.lit(r"^(?:[^/]*\.)?"), _literal(host, "[^/]*")))
    return rules.filter(F.col("verdict").isNotNull()).select(
        F.concat(host, path).alias("_rule"), F.col("verdict").alias("_verdict"),
        F.concat(fits, F.lit(r"(?=/|\z)"), _literal(path, r"(?s:.*)")).alias("_pattern"),
        F.array_distinct(F.concat(
            _tagged(F.regexp_extract_all(host, F.lit(rf"(?<![*{_T}])([{_T}]+)(?![*{_T}])")), "h:"),
            _tagged(F.regexp_extract_all(path, F.lit(rf"(?<![*{_T}])([{_T}]+)(?=[^*{_T}])")), "p:"))).alias("_tokens")).distinct()


def indexed(rules: DataFrame, urls: DataFrame, small: bool) -> DataFrame:
    """The compiled rules with ``_token``, the one of ``_tokens`` that the fewest of ``urls`` (``_host, _path``) hold; "" without any."""
    wanted = rules.select(F.explode("_tokens").alias("_token")).distinct()
    held = urls.select(F.explode(url_tokens(F.col("_host"), F.col("_path"))).alias("_token"))
    if small:  # proven: the tokens of INDEX_RULES rules at most
        held = held.join(F.broadcast(wanted), "_token", "left_semi")
    counts = held.groupBy("_token").agg(F.count(F.lit(1)).alias("_urls"))
    owned = rules.select("_rule", "_verdict", "_pattern", F.explode_outer("_tokens").alias("_token")).join(counts, "_token", "left")
    rarest = F.min(F.struct(F.coalesce("_urls", F.lit(0)), F.col("_token")))["_token"]
    return owned.groupBy("_rule", "_verdict", "_pattern").agg(F.coalesce(rarest, F.lit("")).alias("_token"))


def _order(rule: Column) -> Column:
    return F.struct(F.length(rule["_rule"]).alias("n"), (rule["_verdict"] == "block").alias("b"), rule["_rule"].alias("rule"), rule["_verdict"].alias("verdict"))


def _held_by_row(urls: DataFrame, index: DataFrame) -> DataFrame:
    """``_best`` of every row by an index that travels as one value: SLOTS lists of (token, rules)."""
    entry = index.groupBy("_token").agg(F.collect_list(F.struct("_rule", "_verdict", "_pattern")).alias("_rules"))
    slot = F.pmod(F.xxhash64("_token"), F.lit(SLOTS)).cast("int")
    slots = entry.groupBy(slot.alias("_slot")).agg(F.collect_list(F.struct("_token", "_rules")).alias("_entries"))
    slots = slots.agg(F.map_from_entries(F.collect_list(F.struct("_slot", "_entries"))).alias("_by"))
    slots = slots.select(F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda s: F.coalesce(F.col("_by")[s], F.array())).alias("_slots"))
    # bounded by INDEX_RULES; as JSON it is one literal, which Spark parses once, when it folds constants
    text = slots.select(F.to_json(F.coalesce("_slots", F.array()))).first()[0]
    value = F.from_json(F.lit(text), slots.schema["_slots"].dataType)
    url = F.concat("_host", "_path")
    fetched = F.flatten(F.transform(url_tokens(F.col("_host"), F.col("_path")), lambda t: F.flatten(F.transform(
        F.filter(F.coalesce(F.get(value, F.pmod(F.xxhash64(t), F.lit(SLOTS)).cast("int")), F.array()), lambda e: e["_token"] == t), lambda e: e["_rules"]))))
    return urls.withColumn("_best", F.array_max(F.transform(F.filter(fetched, lambda r: F.regexp(url, r["_pattern"])), _order)))


def _held_by_join(urls: DataFrame, index: DataFrame) -> DataFrame:
    """``_best`` of every row by a salted join of the distinct URLs' tokens with the index."""
    salted = index.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    distinct = urls.select("_host", "_path").distinct()
    tokens = distinct.withColumns({"_token": F.explode(url_tokens(F.col("_host"), F.col("_path"))),
                                   "_salt": F.pmod(F.xxhash64("_host", "_path"), F.lit(SALTS)).cast("int")})
    fits = tokens.join(salted, ["_token", "_salt"]).filter(F.regexp(F.concat("_host", "_path"), F.col("_pattern")))
    best = fits.groupBy("_host", "_path").agg(F.max(_order(F.struct("_rule", "_verdict", "_pattern"))).alias("_best"))
    return urls.join(best, ["_host", "_path"], "left")


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow", index_rules: int = INDEX_RULES) -> DataFrame:
    """All columns of ``pages`` and, under names it has not taken, ``host, path, rule, verdict`` of its URLs.

    ``rules`` has ``host, path, verdict``. Where no rule fits, ``rule`` is null and the
    verdict is ``default``. Null and malformed URLs have an empty host and path and meet
    only rules for any host without a path. Repeated rows are judged alike, each for itself;
    an empty table gives an empty result, an empty rule table the default throughout.
    """
    prepare(pages.sparkSession)
    host, path, best, rule, verdict = free(pages, "host", "path", "best", "rule", "verdict")
    parts = dict(zip(("_host", "_path"), url_parts(F.col(url_col))))
    compact = compiled(rules)
    small = compact.limit(index_rules + 1).count() <= index_rules
    index = indexed(compact, pages.select(*[c.alias(n) for n, c in parts.items()]), small)
    # the caller's columns travel as one struct, so none of their names can clash
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("_row"), *[c.alias(n) for n, c in parts.items()])
    met = (_held_by_row if small else _held_by_join)(rows, index)
    return met.select("_row.*", F.col("_host").alias(host), F.col("_path").alias(path), F.col("_best.rule").alias(rule),
                      F.coalesce("_best.verdict", F.lit(default)).alias(verdict))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A rule table of (verdict, host, path) values."""
    return spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for v, h, p in rules])))


#: The rules of the registered query.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op11_url_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the four rules; what no rule fits is allowed."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rule_table(spark, RULES)).select("page_id", "host", "path", "rule", "verdict")


OP11_SQL = f"""
WITH rules(verdict, h, p) AS (VALUES {", ".join(map(str, RULES))}),
r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
d AS (SELECT DISTINCT host, path FROM u),
f AS (SELECT d.host, d.path, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM d JOIN rules ON (d.host = h OR ends_with(d.host, '.' || h)) AND starts_with(d.path, p) GROUP BY ALL)
SELECT page_id, u.host, u.path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN f USING (host, path)
"""
