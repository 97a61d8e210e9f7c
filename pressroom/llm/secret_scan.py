r"""Secret scans of a history of texts with an incremental ledger of blobs.

A row of the history is a version of a path: path columns and a text. The text's
address is its SHA-256, so equal texts are one blob wherever and whenever they
occur. The ledger is a Parquet table of ``blob, rules, findings``: which rules
(``kind@version``) have been run over a blob, and what they found. A scan

1. addresses every version (the texts stay where they are),
2. takes the blobs for which the ledger lacks a rule of the present set, with the
   missing rules only,
3. runs those rules over one copy of each such blob and appends what they say to
   the ledger, and
4. joins the ledger's findings back to all versions by address.

So a text that was scanned before, in this run or an earlier one, isn't scanned
again; a rule whose version changes is run over every blob, the others aren't.
Copies are reduced to one within each task before the shuffle, and the last join
has plain inputs on both sides, so that a text which holds a third of all rows
neither gathers its copies in one task nor its findings. A scan that dies before
its append leaves the ledger as it was; after it, a repeated run finds its blobs
scanned.

Matches of a rule are leftmost and do not overlap; of these, those are kept whose
measured group is long enough. A finding is ``kind, start, end`` in code points of
the whole match, end exclusive. Kinds ``assign``, ``access`` and ``hex`` are the
base rules; ``pem`` (a private key with its armour) and ``jwt`` (a signed token of
three parts) come with the method.

A null text is empty. Path columns are returned as they are (null, repeated, any
type), repeated rows one by one; other columns are ignored; an empty history gives
no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pressroom.llm.common import materialize, read
from pressroom.sources.staging import staging_path


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str
    group: int = 0   # whose length is measured
    least: int = 0   # code points that it must have

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


def either_case(word: str) -> str:
    """A pattern of ``word`` with its letters A-Z in either case."""
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", word)


#: The base rules, in the order of their kinds.
KEYWORDS = "password|passwd|secret|token|api_?key"
ASSIGN = f"({either_case(KEYWORDS)})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
BASE = (Rule("assign", 1, ASSIGN, group=2, least=6),
        Rule("access", 1, "AKIA[A-Z0-9]+", least=20),
        Rule("hex", 1, "[0-9a-f]+", least=24))
RULES = BASE + (
    Rule("pem", 1, "-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\\x0A\\x0D\\x20]+-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
    Rule("jwt", 1, "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", least=40))

LEDGER = "blob string, rules array<string>, findings array<struct<kind:string,start:bigint,end:bigint>>"


def matches(rule: Rule, text: str) -> list[tuple[str, int, int]]:
    return [(rule.kind, m.start(), m.end()) for m in re.finditer(rule.pattern, text)
            if m.end(rule.group) - m.start(rule.group) >= rule.least]


def run_rules(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Ledger rows of ``blob, rules, text``: each text under its own rules."""
    known = {r.name: r for r in rules}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [[{"kind": k, "start": a, "end": b} for n in names for k, a, b in matches(known[n], text)]
                     for names, text in zip(batch["rules"], batch["text"])]
            yield pd.DataFrame({"blob": batch["blob"], "rules": batch["rules"], "findings": found})

    return blobs.select("blob", "rules", "text").mapInPandas(run, LEDGER)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's rows; none if nothing has been written there yet."""
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def scan_history(history: DataFrame, ledger: str, paths: Sequence[str], text_col: str = "text",
                 rules: Sequence[Rule] = RULES) -> DataFrame:
    """Bring the ledger up to date with ``history`` and return, for each of its
    rows, the ``paths`` columns, ``blob`` and ``findings`` (of the present rules,
    by start, then in the rules' order)."""
    spark = history.sparkSession
    order = {r.kind: k for k, r in enumerate(rules)}
    if len(order) < len(rules):
        raise ValueError("one rule a kind")
    names = F.array(*[F.lit(r.name) for r in rules])
    text = F.coalesce(F.col(text_col), F.lit(""))
    blobs = history.select(F.sha2(text, 256).alias("blob"), text.alias("text")).groupBy("blob").agg(
        F.first("text").alias("text"))
    ran = read_ledger(spark, ledger).groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("ran"))
    unseen = (blobs.join(ran, "blob", "left")
              .withColumn("rules", F.array_except(names, F.coalesce("ran", F.array().cast("array<string>"))))
              .where(F.size("rules") > 0))
    run_rules(unseen, rules).write.mode("append").parquet(ledger)

    # one row a blob and current rule; two scans at the same time may both have written it
    one = (read_ledger(spark, ledger).select("blob", F.explode("rules").alias("rule"), "findings")
           .where(F.array_contains(names, F.col("rule")))
           .withColumn("findings", F.filter("findings", lambda x: x["kind"] == F.substring_index("rule", "@", 1)))
           .groupBy("blob", "rule").agg(F.first("findings").alias("findings"))
           .groupBy("blob").agg(F.flatten(F.collect_list("findings")).alias("findings")))
    rank = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    keyed = F.transform("findings", lambda x: F.struct(x["start"].alias("start"), rank[x["kind"]].alias("rank"),
                                                       x["end"].alias("end"), x["kind"].alias("kind")))
    sorted_ = F.transform(F.array_sort(keyed), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"),
                                                                  x["end"].alias("end")))
    found = materialize(one.where(F.size("findings") > 0).select("blob", sorted_.alias("findings")), "findings")
    versions = history.select(F.struct(*[F.col(p) for p in paths]).alias("path"), F.sha2(text, 256).alias("blob"))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return (versions.join(found, "blob", "left")
            .select("path.*", "blob", F.coalesce("findings", none).alias("findings")))


def written(findings: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def op12_secret_scan(spark, sf_dir):
    documents = read(spark, sf_dir, "documents")
    rows = scan_history(documents, staging_path(spark, "blob-ledger"), ["doc_id"])
    count = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("findings", lambda x: x["kind"].isin([r.kind for r in BASE]))
    return rows.select("doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in BASE],
                       F.sha2(written(base), 256).alias("base_sha256"), written(F.col("findings")).alias("spans"))


def _found(rule: Rule, rank: int) -> str:
    """Matches of a rule in DuckDB: the text between matches gives their places."""
    pattern = rule.pattern.replace("'", "''")
    measured = f"regexp_extract(m, '^(?:{pattern})$', {rule.group})" if rule.group else "m"
    return f"""
SELECT no, {rank} AS rank, '{rule.kind}' AS kind, a AS start_, a + length(m) AS end_ FROM (
  SELECT no, unnest(ms) AS m, unnest(list_transform(range(1, len(ms) + 1), lambda k:
         list_sum(list_transform(gaps[1:k], lambda g: length(g))) + coalesce(list_sum(list_transform(ms[1:k - 1], lambda g: length(g))), 0)))::BIGINT AS a
  FROM (SELECT no, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS gaps FROM docs))
WHERE length({measured}) >= {rule.least}"""


ORACLE = f"""
WITH docs AS (SELECT row_number() OVER () AS no, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({' UNION ALL '.join(_found(r, k) for k, r in enumerate(RULES))}),
said AS (SELECT no, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         coalesce(string_agg(kind || ':' || start_ || ':' || end_, ',' ORDER BY start_, rank) FILTER (rank < {len(BASE)}), '') AS base,
         string_agg(kind || ':' || start_ || ':' || end_, ',' ORDER BY start_, rank) AS spans
         FROM found GROUP BY no)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN said USING (no)
"""
