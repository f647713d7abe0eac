"""Mixing sources to target weights: hierarchical budgets over domain, language and source.

Capacities add up from leaf to root, the budget comes down from the root: at each
node the children share it by weight, and what a child cannot use goes to its
siblings first (water filling). An ancestor's other branches get only what the
whole node cannot use, because a node is never given more than its capacity. A leaf
then takes whole epochs and, of one more, the prefix in that epoch's seeded order
that fits its budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paperloom.llm.graph import written

#: Bits of the order hash; documents of a leaf per bucket of it, about.
BITS, PER_BUCKET = 60, 4096

LEAF = ["domain", "lang", "source"]


def _filled(nodes: DataFrame, parent: list[str], given: DataFrame | float) -> DataFrame:
    """``nodes(parent…, name…, weight, cap)`` with ``amount``: the parent's budget (the root's is one number), shared by weight up to each capacity.

    Children are ordered by capacity per weight. Were all before a child full, the
    rest would be shared at ``level`` per weight; the first child that can hold
    more than that sets the level for itself and all after it.
    """
    name = [c for c in nodes.columns if c not in (*parent, "weight", "cap")]
    at = nodes.where("weight > 0 and cap > 0").withColumn("ratio", F.col("cap") / F.col("weight"))
    at = at.join(given, parent) if parent else at.withColumn("budget", F.lit(given))
    order = W.partitionBy(*parent).orderBy("ratio", *name)
    full = F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    at = at.withColumn("level", (F.col("budget") - full) / F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)))
    at = at.withColumn("turn", F.row_number().over(order))
    level = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("turn", "level"))).over(W.partitionBy(*parent))["level"]
    amount = F.when(level.isNull(), F.col("cap").cast("double")).otherwise(F.least(F.col("cap").cast("double"), level * F.col("weight")))
    return at.withColumn("amount", amount).select(*parent, *name, "amount")


def order_hash(seed: int, epoch: Column, key: Column) -> Column:
    """A document's place in an epoch: 60 bits of an md5."""
    text = F.concat_ws("/", F.lit(str(seed)), epoch.cast("string"), key.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def budgets(leaves: DataFrame, weight_of: dict[str, Column], percent: int, epochs: int) -> DataFrame:
    """``leaves(domain, lang, source, tokens)`` with ``budget`` in tokens, at most ``epochs`` times the leaf's own."""
    cap = leaves.withColumn("cap", F.col("tokens") * epochs)
    total = leaves.agg(F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * percent / 100).cast("double")).first()[0]
    up = lambda keys: cap.groupBy(*keys).agg(F.sum("cap").alias("cap")).withColumn("weight", weight_of[keys[-1]].cast("long"))
    amount = _filled(up(LEAF[:1]), [], total)
    for depth in (2, 3):
        amount = _filled(up(LEAF[:depth]), LEAF[: depth - 1], amount.withColumnRenamed("amount", "budget"))
    return leaves.join(amount, LEAF, "left").withColumn("budget", F.floor(F.coalesce("amount", F.lit(0.0)) + 1e-6).cast("long")).drop("amount")


def _cuts(rows: DataFrame, leaves: DataFrame, seed: int) -> DataFrame:
    """Per leaf: whole epochs, and the last place of the prefix of one more.

    Rows of an id stand at one place. Sums per bucket of the order find the bucket
    in which the prefix ends; only its rows are ordered.
    """
    most = leaves.agg(F.coalesce(F.max("docs"), F.lit(0))).first()[0]
    bits = max(1, (most // PER_BUCKET).bit_length())
    leaves = leaves.withColumn("whole", F.floor(F.col("budget") / F.col("tokens")).cast("int")).withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))
    open_leaves = leaves.where("rest > 0").select(*LEAF, "whole", "rest")
    spot = rows.join(open_leaves, LEAF).withColumn("h", order_hash(seed, F.col("whole"), F.col("id")))
    spot = spot.groupBy(*LEAF, "rest", "h", "id").agg(F.sum("tokens").alias("t")).withColumn("bucket", F.shiftright("h", BITS - bits))
    spot = written(spot, "mix-order")
    sums = spot.groupBy(*LEAF, "rest", "bucket").agg(F.sum("t").alias("t"))
    before = F.coalesce(F.sum("t").over(W.partitionBy(*LEAF).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cut = sums.withColumn("before", before).where((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("t") > F.col("rest")))
    cut = written(cut.select(*LEAF, "bucket", "before"), "mix-cut")
    inside = spot.join(cut, [*LEAF, "bucket"])
    run = F.col("before") + F.sum("t").over(W.partitionBy(*LEAF).orderBy("h", "id").rowsBetween(W.unboundedPreceding, 0))
    last = inside.withColumn("run", run).where("run <= rest").groupBy(*LEAF).agg(F.max(F.struct("h", "id")).alias("last"))
    start = F.shiftleft(F.col("bucket"), BITS - bits) - 1
    ends = cut.join(last, LEAF, "left").select(*LEAF, F.coalesce("last", F.struct(start.alias("h"), F.lit(2**63 - 1).alias("id"))).alias("last"))
    return leaves.select(*LEAF, "whole", "budget").join(ends, LEAF, "left")


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mix(docs: DataFrame, domain: Column, weight_of: dict[str, Column], percent: int = 100, epochs: int = 2, seed: int = 1, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``docs`` with ``_copies``: how often each row enters the mix, 0 included.

    ``domain`` is computed on ``docs``; ``weight_of`` gives whole, non-negative
    weights over ``domain``, ``lang`` and ``source`` for each level, relative among
    siblings. ``percent`` of all tokens (words) is asked for. Null domains,
    languages and sources are branches of their own with the empty name. Rows
    without words cost nothing and enter once if their leaf has a budget. Rows of
    one id stand or fall together; null ids count as one id. A branch of weight 0
    gets nothing.
    """
    named = [F.coalesce(domain.cast("string"), F.lit("")), F.coalesce(F.col(lang_col).cast("string"), F.lit("")), F.coalesce(F.col(source_col).cast("string"), F.lit(""))]
    rows = docs.select(*[c.alias(n) for c, n in zip(named, LEAF)], F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("id"), words_of(F.col(text_col)).alias("tokens"))
    rows = written(rows, "mix-rows")
    leaves = rows.where("tokens > 0").groupBy(*LEAF).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))
    leaves = written(budgets(leaves, weight_of, percent, epochs), "mix-budgets")
    # One row per leaf; Spark broadcasts it where it is small enough.
    cuts = written(_cuts(rows.where("tokens > 0"), leaves, seed), "mix-cuts")
    cuts = cuts.select(*[F.col(c).alias("__" + c) for c in (*LEAF, "whole", "budget", "last")])
    same = (named[0] == F.col("__domain")) & (named[1] == F.col("__lang")) & (named[2] == F.col("__source"))
    key = F.coalesce(docs[id_col].cast("long"), F.lit(-(2**63)))
    h = order_hash(seed, F.col("__whole"), key)
    extra = F.coalesce((F.struct(h.alias("h"), key.alias("id")) <= F.col("__last")).cast("int"), F.lit(0))
    copies = F.when(words_of(docs[text_col]) > 0, F.col("__whole") + extra).otherwise((F.col("__budget") > 0).cast("int"))
    return docs.join(cuts, same, "left").select(*[docs[c] for c in docs.columns], F.coalesce(copies, F.lit(0)).alias("_copies"))


def mixed_rows(mixed: DataFrame) -> DataFrame:
    """The rows of ``mix`` as often as they enter it."""
    return mixed.where("_copies > 0").withColumn("_copies", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copies")
