"""Secret scans through an incremental blob ledger.

Every text is content-addressed (SHA-256): that is its blob.  The ledger, a
folder of append-only Parquet tables, holds

* ``paths``: (path, blob) of every version that any run has seen, and
* ``scans``: (blob, rules, found): which rule versions have scanned a blob, and
  the spans that they found.

A run scans one copy of each blob, and only for the rule versions that have not
seen it; findings are then joined back to all paths.  All of it is DataFrame
operations.  Only texts in which some rule's pattern occurs are dealt, once and by
path, so that copies of one blob (they may be a third of all rows) never meet; what
meets is one small row per path.

Spans count code points, end exclusive.  A null text is an empty one; a null
path is a path; rows that share a path and a text are scanned as often as they are
repeated and recorded once, rows that share only a path are versions of it.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import free_name, staged, utf8

FOUND = "array<struct<start:int,kind:int,end:int,rule:string>>"


class Rule(NamedTuple):
    """``pattern`` matches leftmost and without overlaps; a match whose group
    ``group`` has under ``least`` characters is dropped.  A text without
    ``hint`` (if there is one) has no match."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    hint: str = ""

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


#: The base rules.  A run of 16 characters or more is what is left
#: of all runs when shorter ones are dropped, so the length is in the pattern.
BASE = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 12),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}", hint="AKIA"),
    Rule("hex", 1, r"[0-9a-f]{16,}"),
)
#: Further kinds, found beside the base ones.
MORE = (
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", hint="gh"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hint="eyJ"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hint="-----BEGIN "),
)
RULES = BASE + MORE


def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """The rule's spans in a text.  Splitting at the pattern gives the pieces
    between its matches, whose lengths give the places."""
    pattern = F.lit(rule.pattern)
    # Arrays that are zipped once; inside the lambda they are not computed anew.
    zipped = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"),
                          F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"))
    start = F.struct(F.lit(0).alias("at"), F.lit(None).cast(FOUND).alias("out"))

    def step(acc, z):
        begin = acc["at"] + F.length(z["gap"])
        end = begin + F.length(z["hit"])
        span = F.array(F.struct(begin.alias("start"), F.lit(order).alias("kind"), end.alias("end"),
                                F.lit(rule.id).alias("rule"))).cast(FOUND)
        good = (F.length(F.regexp_extract(z["hit"], rule.pattern, rule.group)) >= rule.least
                if rule.group else F.lit(True))
        out = F.when(good, F.concat(F.coalesce(acc["out"], F.array().cast(FOUND)), span)).otherwise(acc["out"])
        return F.when(z["hit"].isNull(), acc).otherwise(
            F.struct(end.alias("at"), out.alias("out")))

    spans = F.aggregate(zipped, start, step, lambda acc: acc["out"])
    return F.when(may_match(text, rule), spans)


def may_match(text: Column, rule: Rule) -> Column:
    can = text.rlike(rule.pattern)
    return text.contains(rule.hint) & can if rule.hint else can


def suspect(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether a rule's pattern is in the text at all.  It is told while the text
    is read, so that only such texts are ever dealt among the tasks."""
    found = F.lit(False)
    for rule in rules:
        found = found | may_match(text, rule)
    return found


def table_or_none(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.schema(schema).parquet(f"{path}/*") if there else None


def ledger_scans(spark: SparkSession, ledger: str) -> DataFrame | None:
    return table_or_none(spark, f"{ledger}/scans", f"blob binary, rules array<string>, found {FOUND}")


def ledger_paths(spark: SparkSession, ledger: str, kind: str) -> DataFrame | None:
    return table_or_none(spark, f"{ledger}/paths", f"path {kind}, blob binary")


def blob_of(text: str | Column) -> Column:
    return F.unhex(F.sha2(utf8(text).cast("binary"), 256))


def update(docs: DataFrame, ledger: str, key: str = "doc_id", text: str = "text",
           rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Bring the ledger up to date with ``docs``; returns their (path, blob)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("path"), utf8(text).alias("text"))
    rows = rows.withColumn("blob", blob_of("text"))
    run = uuid.uuid4().hex
    kind = rows.schema["path"].dataType.simpleString()
    rows.select("path", "blob", suspect(F.col("text"), rules).alias("suspect")).write.parquet(f"{ledger}/paths/run={run}")
    paths = spark.read.schema(f"path {kind}, blob binary, suspect boolean").parquet(f"{ledger}/paths/run={run}")

    wanted = F.array(*[F.lit(r.id) for r in rules])
    todo = paths.groupBy("blob", "suspect").agg(F.min("path").alias("first"))
    seen = ledger_scans(spark, ledger)
    if seen is None:
        todo = todo.withColumn("todo", wanted)
    else:
        seen = seen.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("seen"))
        todo = (todo.join(seen, "blob", "left")
                .withColumn("todo", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))))
                .where(F.size("todo") > 0).drop("seen"))
    none = F.array().cast(FOUND)
    todo = staged(todo, "secret-todo")
    clean = todo.where(~F.col("suspect")).select("blob", F.col("todo").alias("rules"), none.alias("found"))
    todo = todo.where("suspect").select(F.col("blob").alias("b"), "first", "todo")
    unseen = rows.where(suspect(F.col("text"), rules)).join(
        todo, F.col("path").eqNullSafe(F.col("first")) & (F.col("blob") == F.col("b")))
    spans = [F.coalesce(F.when(F.array_contains("todo", r.id), rule_spans(F.col("text"), r, i)), none)
             for i, r in enumerate(rules)]
    (unseen.select("blob", F.col("todo").alias("rules"), F.concat(*spans).alias("found"))
     .dropDuplicates(["blob"]).unionByName(clean)
     .write.parquet(f"{ledger}/scans/run={run}"))
    return paths.drop("suspect")


def findings(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, found) of every blob with spans of the given rules, sorted by
    start, then by the rules' order."""
    scans = ledger_scans(spark, ledger).select("blob", F.explode("found").alias("f"))
    return (scans.where(F.col("f.rule").isin(*[r.id for r in rules])).distinct()
            .groupBy("blob").agg(F.array_sort(F.collect_list("f")).alias("found")))


def scan(docs: DataFrame, ledger: str, key: str = "doc_id", text: str = "text",
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Bring the ledger up to date with ``docs`` and return (path, blob, found)
    for every row of ``docs``; ``found`` is empty where nothing is."""
    paths = update(docs, ledger, key, text, rules)
    # Stored before the join: the paths of a blob with very many copies can then
    # be split among tasks (an aggregate beside them would hold them together).
    found = staged(findings(docs.sparkSession, ledger, rules), "secret-findings")
    return (paths.join(found, "blob", "left")
            .select("path", "blob", F.coalesce("found", F.array().cast(FOUND)).alias("found")))


def redact(docs: DataFrame, ledger: str, key: str = "doc_id", text: str = "text",
           size: str | None = "n_chars", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the same columns, every span of their texts masked, and the
    column of text lengths (if there is one) set anew where a text changes."""
    update(docs, ledger, key, text, rules)
    blob, spans, clean = (free_name(docs, x) for x in ("blob", "spans", "clean"))
    found = staged(findings(docs.sparkSession, ledger, rules)
                   .select(F.col("blob").alias(blob), F.col("found").alias(spans)), "secret-findings")
    # Texts without a match stay where they are read.
    held = suspect(utf8(text), rules)
    rows = docs.where(held).withColumn(blob, blob_of(text)).join(found, blob, "left")
    rows = rows.withColumn(clean, F.when(F.col(spans).isNull(), F.col(text))
                           .otherwise(redacted(F.col(text), F.col(spans))))
    out = {text: F.col(clean)}
    if size in docs.columns:
        kind = docs.schema[size].dataType
        out[size] = F.when(F.col(spans).isNull(), F.col(size)).otherwise(F.length(clean).cast(kind))
    return docs.where(~held).unionByName(rows.select(*[out.get(c, F.col(c)).alias(c) for c in docs.columns]))


def spans_text(found: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(found, lambda f: F.concat_ws(
        ":", F.element_at(kinds, f["kind"] + 1), f["start"].cast("string"), f["end"].cast("string"))), ",")


def redacted(text: Column, found: Column, mask: str = "[REDACTED]") -> Column:
    """The text with every span (overlapping ones as one) replaced by ``mask``."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, f):
        fresh = f["start"] >= acc["at"]
        out = F.concat(acc["out"], F.substring(text, acc["at"] + 1, f["start"] - acc["at"]), F.lit(mask))
        return F.struct(F.greatest(acc["at"], f["end"]).alias("at"),
                        F.when(fresh, out).otherwise(acc["out"]).alias("out"))

    whole = F.aggregate(found, start, step, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(found) == 0, text).otherwise(whole)
