"""Secret scans over history with an incremental blob ledger, by DataFrame functions only.

Every historical version of a path is content-addressed by the SHA-256 of its
text.  The ledger is an append-only Parquet table of (blob, rules, spans): which
rule versions scanned a blob, and what they found.  A run scans only (blob, rule
version) pairs that the ledger lacks, each blob once however many paths hold
it, appends the result, and joins the findings back to all paths.

Defined results: NULL text counts as empty; a blob that many paths share (a
third of all rows, say) is scanned once and joined back by a join that AQE can
split; NULL ids are ordinary paths; rows that repeat id and text give a row
each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm.common import stage, text_or_empty
from lakeward.llm.spans import with_spans


@dataclass(frozen=True)
class Rule:
    """A pattern, the version under which the ledger knows it, and the length that a match needs."""

    kind: str
    version: int
    pattern: str
    group: int
    min_chars: int

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


#: Fixed by the contract of the scan, in the order in which kinds are listed.
#: Possessive quantifiers change no match: nothing after them could use what they give back.
RULES = (
    Rule("assign", 1, "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]++)", 2, 8),
    Rule("access", 1, "AKIA[A-Z0-9]++", 0, 16),
    Rule("hex", 1, "[0-9a-f]{32,}+", 0, 32),
)

LEDGER_SCHEMA = "blob binary, rules array<string>, spans array<struct<s:int,ord:int,e:int,kind:string,rule:string>>"
SPANS = LEDGER_SCHEMA.rpartition("spans ")[2]


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; empty if nothing was ever written there."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def _versions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("blob"))


def _scan(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """blob, rules, spans of texts (blob, rules, text): each text is searched by its own ``rules`` only."""
    kinds = []
    for order, rule in enumerate(rules):
        wanted = F.when(F.array_contains("rules", rule.id), F.col("text")).otherwise("")
        texts = with_spans(texts, f"found_{rule.kind}", wanted, rule.pattern)

        def long_enough(x: Column) -> Column:
            part = F.regexp_extract(x["m"], rule.pattern, rule.group) if rule.group else x["m"]
            return F.length(part) >= rule.min_chars

        kinds.append(F.transform(F.filter(f"found_{rule.kind}", long_enough), lambda x: F.struct(
            x["s"].alias("s"), F.lit(order).alias("ord"), x["e"].alias("e"),
            F.lit(rule.kind).alias("kind"), F.lit(rule.id).alias("rule"))))
    return texts.select("blob", "rules", F.concat(*kinds).alias("spans"))


def unseen(ids: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, doc_id, rules: each blob that lacks a rule version, one path that holds it, the rules it lacks."""
    known = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("known"))
    blobs = ids.groupBy("blob").agg(F.min("doc_id").alias("doc_id"))
    every = F.array(*[F.lit(r.id) for r in rules])
    lacking = F.array_except(every, F.coalesce("known", F.array().cast("array<string>")))
    return blobs.join(known, "blob", "left").select("blob", "doc_id", lacking.alias("rules")).where(F.size("rules") > 0)


def scan_history(
    docs: DataFrame, ledger_path: str, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Scan what the ledger at ``ledger_path`` lacks, append it there, and return all paths' findings.

    One row per row of ``docs``: doc_id, blob, spans (s, ord, e, kind, rule), in the order of start, then kind.
    """
    spark = docs.sparkSession
    versions = _versions(docs, id_col, text_col)
    ids = stage(versions.select("doc_id", "blob"), "versions")
    todo = stage(unseen(ids, read_ledger(spark, ledger_path), rules), "unseen")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("-")).alias("path")
    # rows that repeat id and text are one before anything is scanned
    texts = versions.select(key, "blob", "text").dropDuplicates(["path", "blob"]).join(todo.select(key, "blob", "rules"), ["path", "blob"])
    _scan(texts.select("blob", "rules", "text"), rules).write.mode("append").parquet(ledger_path)

    current = F.array(*[F.lit(r.id) for r in rules])
    findings = stage(
        read_ledger(spark, ledger_path)
        .select("blob", F.filter("spans", lambda x: F.array_contains(current, x["rule"])).alias("spans"))
        .where(F.size("spans") > 0)
        .groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans")),
        "findings",
    )
    found = F.coalesce("spans", F.array().cast(SPANS))
    return ids.join(findings, "blob", "left").select("doc_id", "blob", found.alias("spans"))
