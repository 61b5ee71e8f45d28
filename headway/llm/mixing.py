"""Mixing sources to target weights by hierarchical budgeting.

Rows form a tree (by default domain, language, source).  A token budget enters
at the root and every node shares its budget among its children by weight; no
child gets more than its capacity (its tokens times ``max_epochs``), and what
it can't take goes to its siblings by weight.  As a node's capacity is the sum
of its leaves' capacities, a shortage leaves a subtree only when all of it is
used up: siblings come before ancestors.  Each leaf then takes a token-prefix of
its seeded epochs: whole passes, and of one more pass the documents, in the
order of a seeded hash, whose running sum of tokens stays within the rest.

Only integers are used (shares are rounded down, so up to one token per child
stays unspent).  The tree has one small row per leaf; the running sums over
documents are taken over hash buckets first and then inside the one bucket per
leaf where the rest ends, so that a leaf with a third of all rows is never one
task.  A null level value is a value of its own, a null text has no tokens,
rows without a key order by their text's hash, and repeated rows are told apart
by nothing (each counts).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import staged, utf8

NULL = "\x00null"
BUCKET_DIGITS = 3


def tokens(text: str | Column) -> Column:
    """Maximal runs of characters that aren't ASCII white space."""
    return F.regexp_count(utf8(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _big(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(38,0)")


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, int]],
                 budget: Callable[[int], int], max_epochs: int) -> DataFrame:
    """``leaves`` (levels, supply) with a column ``budget``; ``budget`` makes the
    root's budget from the supply of all."""
    nodes = {}
    for depth in range(len(levels), 0, -1):
        nodes[depth] = leaves.groupBy(*levels[:depth]).agg(
            (F.sum("supply") * max_epochs).cast("long").alias("cap"))
    total = leaves.agg(F.sum("supply")).first()[0] or 0
    out = None
    for depth, level in enumerate(levels, 1):
        given = weights.get(level, {})
        weight = F.lit(1)
        if given:
            named = F.create_map(*[F.lit(x) for kv in sorted(given.items()) for x in kv])
            weight = F.coalesce(F.try_element_at(named, F.col(level)), F.lit(1))
        parent = levels[:depth - 1]
        child = (nodes[depth].join(out, parent) if parent else nodes[depth].withColumn(
            "parent_budget", F.lit(min(budget(total), total * max_epochs)).cast("long")))
        child = child.withColumn("w", weight.cast("long")).withColumn(
            "ratio", F.when(F.col("w") > 0, F.col("cap").cast("double") / F.col("w")).otherwise(float("inf")))
        by = Window.partitionBy(*(parent or [F.lit(0)]))
        order = by.orderBy("ratio", level)
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        child = (child
                 .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
                 .withColumn("w_left", F.sum("w").over(by) - F.coalesce(F.sum("w").over(before), F.lit(0)))
                 .withColumn("full", (F.col("w") > 0) & (
                     _big("cap") * _big("w_left")
                     <= _big(F.col("parent_budget") - F.col("cap_before")) * _big("w")))
                 .withColumn("cap_full", F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(by))
                 .withColumn("w_open", F.sum(F.when(F.col("full"), 0).otherwise(F.col("w"))).over(by)))
        share = F.expr("cast((cast(parent_budget - cap_full as decimal(20,0)) * cast(w as decimal(18,0)))"
                       " div greatest(w_open, 1) as bigint)")
        child = child.withColumn("got", F.when(F.col("full"), F.col("cap")).otherwise(share))
        out = child.select(*levels[:depth], F.col("got").alias("parent_budget"))
    return leaves.join(out.withColumnRenamed("parent_budget", "budget"), levels)


def _hash(seed: int, epoch: Column, ident: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), ident).cast("binary"))


def plan(rows: DataFrame, levels: list[str], weights: dict[str, dict[str, int]],
         budget: Callable[[int], int], max_epochs: int, seed: int) -> DataFrame:
    """One row per leaf: (levels, passes, bucket, last): a row of the leaf is
    taken ``passes`` times, and once more if its hash of that epoch lies in a
    bucket before ``bucket`` or isn't above ``last``."""
    leaves = rows.groupBy(*levels).agg(F.sum("tokens").alias("supply"))
    budgets = leaf_budgets(leaves, levels, weights, budget, max_epochs)
    budgets = staged(budgets.select(
        *levels, F.expr("case when supply > 0 then budget div supply else 0 end").alias("passes"),
        F.expr("case when supply > 0 then budget % supply else 0 end").alias("rest")), "mix-budgets")
    hashed = (rows.join(budgets, levels)
              .withColumn("h", _hash(seed, F.col("passes"), F.col("_id")))
              .withColumn("bucket", F.substring("h", 1, BUCKET_DIGITS))
              .select(*levels, "passes", "rest", "bucket", "h", "tokens"))
    sums = hashed.groupBy(*levels, "passes", "rest", "bucket").agg(F.sum("tokens").alias("t"))
    run = Window.partitionBy(*levels).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    # The first bucket whose running sum exceeds the rest.
    ends = (sums.withColumn("upto", F.sum("t").over(run)).where(F.col("upto") > F.col("rest"))
            .groupBy(*levels, "passes", "rest")
            .agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("t")).alias("before")),
                          "bucket").alias("e"))
            .select(*levels, F.col("e.bucket").alias("end"), F.col("e.before").alias("before")))
    ends = staged(ends, "mix-ends")
    inside = (hashed.join(ends, levels).where(F.col("bucket") == F.col("end")))
    run = Window.partitionBy(*levels).orderBy("h").rangeBetween(Window.unboundedPreceding, 0)
    # Rows that share a hash share an id: they are taken together or not at all.
    last = (inside.withColumn("upto", F.col("before") + F.sum("tokens").over(run))
            .where(F.col("upto") <= F.col("rest")).groupBy(*levels).agg(F.max("h").alias("last")))
    return staged(budgets.join(ends, levels, "left").join(last, levels, "left")
                  .select(*levels, "passes", "end", "last"), "mix-plan")


def mix(docs: DataFrame, weights: dict[str, dict[str, int]], budget: Callable[[int], int], max_epochs: int = 3,
        seed: int = 1, levels: tuple[str, ...] = ("domain", "lang", "source"), key: str = "doc_id",
        text: str = "text", keep: tuple[str, ...] | None = None,
        names_out: tuple[str, str] = ("tokens", "copies")) -> DataFrame:
    """The rows that are taken, with two results: their tokens and how many epochs
    take the row, under ``names_out``; ``keep`` names the columns to carry (default:
    all, but for columns that have a result's name)."""
    levels = list(levels)
    keep = [c for c in (keep or docs.columns) if c not in names_out]
    # Own columns beside the caller's: no name of theirs can clash.
    names = [f"_mix_{c}" for c in levels]
    tag = [F.coalesce(F.col(c).cast("string"), F.lit(NULL)).alias(n) for n, c in zip(names, levels)]
    ident = F.coalesce(F.col(key).cast("string"), F.md5(utf8(text).cast("binary"))).alias("_mix_id")
    count = tokens(text).alias("_mix_tokens")
    narrow = staged(docs.select(*tag, ident, count), "mix-sizes")
    plain = narrow.select(*[F.col(n).alias(c) for n, c in zip(names, levels)],
                          F.col("_mix_id").alias("_id"), F.col("_mix_tokens").alias("tokens"))
    leaf = plan(plain, levels, weights, budget, max_epochs, seed)
    leaf = leaf.select(*[F.col(c).alias(n) for n, c in zip(names, levels)],
                       *[F.col(c).alias(f"_mix_{c}") for c in ("passes", "end", "last")])
    wide = docs.select(*keep, *tag, ident, count)
    # The plan is a stored table of one row per leaf: the planner broadcasts it
    # where its size allows, and splits hot leaves where it doesn't.
    taken = wide.join(leaf, names).withColumn(
        "_mix_h", _hash(seed, F.col("_mix_passes"), F.col("_mix_id")))
    bucket = F.substring("_mix_h", 1, BUCKET_DIGITS)
    once = F.col("_mix_end").isNotNull() & (
        (bucket < F.col("_mix_end"))
        | ((bucket == F.col("_mix_end"))
           & F.coalesce(F.col("_mix_h") <= F.col("_mix_last"), F.lit(False))))
    copies = (F.col("_mix_passes") + once.cast("long")).cast("long")
    return (taken.withColumn("_mix_copies", copies).where(F.col("_mix_copies") > 0)
            .select(*keep, F.col("_mix_tokens").alias(names_out[0]), F.col("_mix_copies").alias(names_out[1])))
