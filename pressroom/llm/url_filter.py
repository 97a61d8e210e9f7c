r"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a wildcard pattern over ``host + path + query`` (the url after its
first ``://``, host A-Z lower-cased): ``||`` at the start anchors it at the
host or any parent domain of it, ``*`` stands for any run, ``^`` for a
separator or the end, the rest is literal. A host/path rule such as
``example.org/en/1`` is the pattern ``||example.org/en/1``.

1. A literal token of a pattern is an alphanumeric run that every matching url
   holds as a whole token (both of its neighbours in the pattern are
   separators or the anchor).
2. The rules' tokens are counted over all urls; each rule is filed under its
   rarest token. A rule without one is filed under the empty token, which every
   url has, so that it is never missed.
3. Each distinct url's tokens fetch candidate rules by an equi-join; only those
   run their regular expression.
4. Host rules beat patterns, then the longest rule wins, then the smaller text.

Only DataFrame functions run. The rule side is a local relation of known size:
Catalyst broadcasts it below the session's threshold and shuffles beyond it.
Urls are joined as distinct values, so repeated urls cost one match.

Null urls and urls without ``://`` have empty host and path and match no rule;
repeated rows keep their own output row; columns beyond ``id_col`` and
``url_col`` are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pressroom.llm.common import LOWER, UPPER, ascii_lower

ALNUM = "0-9A-Za-z"


@dataclass(frozen=True)
class Rule:
    text: str            # host/path, or a pattern
    action: str          # allow | block
    host_rule: bool = True

    @property
    def pattern(self) -> str:
        return f"||{self.text}" if self.host_rule else self.text


#: host/path rules of the production filter.
HOST_RULES = (Rule("org/", "allow"), Rule("example.org/es/", "block"), Rule("example.org/en/1", "block"),
              Rule("com/fr/", "allow"), Rule("com/de/", "block"))
#: Patterns that judge urls to which no host rule applies; allow when none matches.
PATTERN_RULES = tuple(Rule(p, "block", False) for p in (
    "/wp-admin/", "/cgi-bin/", "/login^", "/signup^", "/cart^", "/checkout^", "||ads.", "||tracker.",
    "/casino/", "/porn/", "*sessionid=", "^action=logout"))
DEFAULT_VERDICT = "allow"


def regex_of(pattern: str) -> str:
    """The pattern as a regular expression (Java's and RE2's syntax)."""
    anchored = pattern.startswith("||")
    out = [r"^([^/?#]*\.)?" if anchored else ""]
    for ch in pattern[2:] if anchored else pattern:
        if ch == "*":
            out.append(r"[\s\S]*")
        elif ch == "^":
            out.append(r"([^0-9A-Za-z_.%-]|$)")
        elif re.fullmatch(r"[!-/:-@\[-`{-~]", ch):
            out.append("\\" + ch)
        else:
            out.append(ch)
    return "".join(out)


def literal_tokens(pattern: str) -> list[str]:
    """Lower-cased tokens that every url matching the pattern holds whole."""
    anchored = pattern.startswith("||")
    body = pattern[2:] if anchored else pattern
    found = []
    for m in re.finditer(f"[{ALNUM}]+", body):
        before, after = body[:m.start()], body[m.end():]
        if (before[-1:] != "*" if before else anchored) and after and after[0] != "*":
            found.append(m[0].lower())
    return sorted(set(found))


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, subject): the parts of the module's definition."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    after = F.substring(rest, F.length(host) + 1, F.length(rest))
    return host, F.regexp_extract(after, r"^[^?#]*", 0), F.concat(host, after)


def tokens(subject: Column) -> Column:
    """Distinct lower-cased alphanumeric runs, and the empty token once."""
    runs = F.split(ascii_lower(subject), f"[^{ALNUM}]+")
    return F.array_distinct(F.concat(F.array(F.lit("")), runs))


def rule_index(urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule under its rarest token, by counts over ``urls(url, token)``."""
    spark = urls.sparkSession
    rows = [(i, r.text, r.action, r.host_rule, len(r.text), regex_of(r.pattern)) for i, r in enumerate(rules)]
    table = spark.createDataFrame(rows, "rid int, rule string, action string, host_rule boolean, size int, regex string")
    pairs = spark.createDataFrame([(i, t) for i, r in enumerate(rules) for t in literal_tokens(r.pattern) or [""]],
                                  "rid int, token string")
    counted = urls.join(pairs.select("token").distinct(), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = (pairs.join(counted, "token", "left").groupBy("rid")
              .agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("token")))
    return table.join(rarest, "rid").drop("rid")


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               rules: Sequence[Rule] = HOST_RULES + PATTERN_RULES, default: str = DEFAULT_VERDICT) -> DataFrame:
    """``id_col, url, host, path, rule, matched, verdict`` per row of ``pages``:
    ``rule`` is the deciding host rule (null if none), ``matched`` the deciding
    rule of either kind."""
    rows = pages.select(F.col(id_col), F.col(url_col).alias("url"))
    host, path, subject = url_parts(F.col("url"))
    exploded = (rows.where(F.col("url").contains("://")).select("url").distinct()
                .select("url", subject.alias("subject"))
                .select("url", "subject", F.explode(tokens(F.col("subject"))).alias("token")))
    index = rule_index(exploded.select("url", "token"), rules)
    hits = exploded.join(index, "token").where(F.rlike(F.col("subject"), F.col("regex")))
    # The longest rule; of equally long ones the smaller text (by min over a negated size).
    best = hits.groupBy("url").agg(F.min_by(
        F.struct("rule", "action", "host_rule"),
        F.struct(~F.col("host_rule"), -F.col("size"), F.col("rule"))).alias("best"))
    out = rows.join(best, "url", "left")
    return out.select(id_col, "url", host.alias("host"), path.alias("path"),
                      F.when(F.col("best.host_rule"), F.col("best.rule")).alias("rule"),
                      F.col("best.rule").alias("matched"),
                      F.coalesce(F.col("best.action"), F.lit(default)).alias("verdict"))


def op1_url_filter(spark, sf_dir):
    from pressroom.llm.common import read

    out = judge_urls(read(spark, sf_dir, "pages"))
    return out.select("page_id", "host", "path", "rule", "verdict", "matched")


def _oracle() -> str:
    values = ",\n".join(f"('{r.text}', '{r.action}', {r.host_rule}, {len(r.text)}, '{regex_of(r.pattern)}')"
                        for r in HOST_RULES + PATTERN_RULES)
    return f"""
WITH rules(rule, action, host_rule, size, regex) AS (VALUES {values}),
rest AS (SELECT page_id, row_number() OVER () AS rn, coalesce(CASE WHEN strpos(url, '://') > 0
                THEN substr(url, strpos(url, '://') + 3) ELSE '' END, '') AS rest FROM pages),
hosts AS (SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
                 substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1) AS tail FROM rest),
parts AS (SELECT page_id, rn, rest, host, tail, regexp_extract(tail, '^[^?#]*') AS path FROM hosts),
hits AS (SELECT p.rn, r.rule, r.action, r.host_rule,
                row_number() OVER (PARTITION BY p.rn ORDER BY r.host_rule DESC, r.size DESC, r.rule) AS k
         FROM parts p JOIN rules r ON p.rest <> '' AND regexp_matches(p.host || p.tail, r.regex))
SELECT p.page_id, p.host, p.path, CASE WHEN h.host_rule THEN h.rule END AS rule,
       coalesce(h.action, '{DEFAULT_VERDICT}') AS verdict, h.rule AS matched
FROM parts p LEFT JOIN hits h ON p.rn = h.rn AND h.k = 1
"""


ORACLE = _oracle()
