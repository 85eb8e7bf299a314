"""Pattern mining.

* Transactions stay an ``array<string>`` column of ``"col=value"`` items.
* Frequent itemsets are grown level by level up to ``max_len``: equal
  transactions are counted once, each level extends the frequent sets of every
  distinct transaction by its later frequent items, and one partial aggregation
  counts the level.
* Rules with multi-item consequents: every non-trivial split of each frequent
  itemset is generated as an array expression (bitmask over the sorted items, at
  most 2^max_len per itemset), then both sides' supports come from two equi-joins
  on the item arrays.  A consequent filter (target rules) is pushed before the
  split: only itemsets holding a target item are expanded.
* Sequential patterns grow item by item.  A sequence holding a pattern is known
  by the earliest place where the pattern can end; it holds a longer one if the
  next item comes after that place.  Any length is found, no sequence is
  collected, and a level is one join on the sequence and two aggregations.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sifter.functions.exprs import NULL_ITEM_TEXT, item
from sifter.operators.ranks import measured

SEP = "|"


def transactions(df: DataFrame, cols: Sequence[str], id_col: str) -> DataFrame:
    """M1 (D15 + D18): ``(tid, items)``; repeated columns are de-duplicated."""
    cols = list(dict.fromkeys(cols))
    return df.select(
        F.col(id_col).alias("tid"),
        F.array_distinct(F.array(*[item(c, F.col(c)) for c in cols])).alias("items"),
    )


def min_count(min_support: float, n: int) -> int:
    return max(1, math.ceil(min_support * n - 1e-9))


def frequent_itemsets(tx: DataFrame, min_support: float, max_len: int = 5, n: int | None = None) -> DataFrame:
    """M3: ``(items sorted, freq, support)`` for itemsets of length <= max_len."""
    distinct = measured(
        tx.select(F.array_sort("items").alias("items")).groupBy("items").agg(F.count(F.lit(1)).alias("w")), "transactions"
    )
    n = n if n is not None else (distinct.agg(F.sum("w")).first()[0] or 0)
    least = min_count(min_support, n)
    # rows: (set found so far, the transaction's items that may extend it, weight)
    rows = distinct.select(F.array().cast("array<string>").alias("found"), F.col("items").alias("rest"), "w")
    out = None
    for length in range(1, max_len + 1):
        grown = rows.select("found", "w", "rest", F.posexplode("rest").alias("at", "item")).select(
            F.concat("found", F.array("item")).alias("found"), F.expr("slice(rest, at + 2, size(rest))").alias("rest"), "w"
        )
        level = grown.groupBy(F.col("found").alias("items")).agg(F.sum("w").alias("freq")).where(F.col("freq") >= least)
        level = measured(level, "itemsets")
        out = level if out is None else out.unionByName(level)
        if length == max_len or level.isEmpty():
            break
        rows = grown.where(F.size("rest") > 0).join(level.select(F.col("items").alias("found")), "found", "left_semi")
        if length == 1:  # only frequent items can extend a set
            single = level.select(F.col("items")[0].alias("item"))
            kept = distinct.select("items", F.explode("items").alias("item")).join(single, "item", "left_semi")
            kept = kept.groupBy("items").agg(F.array_sort(F.collect_list("item")).alias("frequent"))
            items = distinct.join(kept, "items").select("frequent", "w")
            pairs = items.select("w", "frequent", F.posexplode("frequent").alias("at", "item"))
            rows = pairs.select(F.array("item").alias("found"), F.expr("slice(frequent, at + 2, size(frequent))").alias("rest"), "w")
        rows = measured(rows, "itemset-rows")
    return out.select("items", F.col("freq").cast("long").alias("freq"), (F.col("freq") / F.lit(float(n or 1))).alias("support"))


def _splits(items: Column) -> Column:
    """All non-empty proper subsets of a sorted item array (bitmask order)."""
    return F.expr(
        "transform(sequence(1, cast(pow(2, size(items)) as int) - 2), "
        "m -> filter(items, (e, i) -> (shiftright(m, i) & 1) = 1))"
    )


def association_rules(
    itemsets: DataFrame, min_confidence: float, consequent_prefix: str | None = None
) -> DataFrame:
    """M4/M5: ``antecedent, consequent, support, confidence, lift, leverage,
    conviction`` (conviction is null when confidence = 1, i.e. infinite)."""
    cand = itemsets.where(F.size("items") >= 2)
    if consequent_prefix is not None:
        cand = cand.where(F.exists("items", lambda x: x.startswith(consequent_prefix)))
    split = cand.select(
        "items", F.col("support").alias("support"), F.explode(_splits(F.col("items"))).alias("antecedent")
    ).select("support", "antecedent", F.array_except("items", "antecedent").alias("consequent"))
    if consequent_prefix is not None:
        split = split.where(F.exists("consequent", lambda x: x.startswith(consequent_prefix)))
    a = itemsets.select(F.col("items").alias("antecedent"), F.col("support").alias("support_a"))
    c = itemsets.select(F.col("items").alias("consequent"), F.col("support").alias("support_c"))
    rules = split.join(a, "antecedent").join(c, "consequent")
    conf = F.col("support") / F.col("support_a")
    out = rules.select(
        "antecedent", "consequent", "support", conf.alias("confidence"),
        (conf / F.col("support_c")).alias("lift"),
        (F.col("support") - F.col("support_a") * F.col("support_c")).alias("leverage"),
        F.when(conf < 1, (1 - F.col("support_c")) / (1 - conf)).alias("conviction"),
    )
    return out.where(F.col("confidence") >= F.lit(min_confidence) - 1e-12)


def items_text(items: str) -> Column:
    """Items joined by ``SEP``; a separator inside an item is escaped by a backslash."""
    return F.array_join(F.transform(items, lambda x: F.replace(x, F.lit(SEP), F.lit("\\" + SEP))), SEP)


def rules_as_text(rules: DataFrame) -> DataFrame:
    return rules.withColumn("antecedent", items_text("antecedent")).withColumn("consequent", items_text("consequent"))


def threshold_sweep(rules: DataFrame, settings: Sequence[tuple[float, float]]) -> DataFrame:
    """M7: rule counts per (min_support, min_confidence), mined once at the
    loosest setting.  Exact: an itemset at support >= s has all subsets >= s."""
    aggs = [
        F.sum(((F.col("support") >= s - 1e-12) & (F.col("confidence") >= c - 1e-12)).cast("long")).alias(f"n{i}")
        for i, (s, c) in enumerate(settings)
    ]
    row = rules.agg(*aggs)
    cells = F.array(
        *[F.struct(F.lit(float(s)).alias("min_support"), F.lit(float(c)).alias("min_confidence"),
                   F.coalesce(F.col(f"n{i}"), F.lit(0)).alias("n_rules")) for i, (s, c) in enumerate(settings)]
    )
    return row.select(F.inline(cells))


def row_sequences(df: DataFrame, cols: Sequence[str], id_col: str, qualify: bool = False) -> DataFrame:
    """Each row as a sequence of its values in alphabetical column order
    (``qualify=True`` prefixes ``col=``, avoiding cross-column collisions)."""
    ordered = sorted(dict.fromkeys(cols))
    vals = [
        item(c, F.col(c)) if qualify else F.coalesce(F.col(c).cast("string"), F.lit(NULL_ITEM_TEXT))
        for c in ordered
    ]
    return df.select(F.col(id_col).alias("sid"), F.array(*vals).alias("sequence"))


def group_sequences(
    df: DataFrame, group_col: str, order_col: str, item_col: str, min_length: int = 2
) -> DataFrame:
    """Per group, items ordered by ``order_col``; keep length >= min_length.
    The input is already aggregated to one row per (group, order) step, so a
    sequence is as long as there are steps (e.g. decades)."""
    seq = df.groupBy(group_col).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(order_col, item_col))), lambda s: s[item_col]).alias(
            "sequence"
        )
    )
    return seq.where(F.size("sequence") >= min_length)


def sequential_patterns(
    events: DataFrame, seq_col: str, order_cols: Sequence[str], item_col: str,
    min_support_ratio: float, max_length: int | None = None, weight_col: str | None = None,
) -> DataFrame:
    """M8: frequent gapped subsequences (one item per step) with their number
    of supporting sequences.  Minimum count ``max(1, int(ratio * n))``.  All
    lengths are found unless ``max_length`` says otherwise.  ``weight_col``
    counts the equal sequences a sequence stands for (constant in a sequence).
    """
    weight = F.col(weight_col) if weight_col else F.lit(1)
    steps = events.select(
        F.col(seq_col).alias("seq"), F.struct(*[F.col(c) for c in order_cols]).alias("pos"),
        F.col(item_col).alias("item"), weight.cast("long").alias("w"),
    )
    steps = measured(steps, "steps")
    n = steps.groupBy("seq").agg(F.max("w").alias("w")).agg(F.sum("w")).first()[0] or 0
    least = max(1, int(min_support_ratio * n))

    def frequent(held: DataFrame) -> DataFrame:
        return measured(held.groupBy("pattern").agg(F.sum("w").alias("freq")).where(F.col("freq") >= least), "patterns")

    steps = steps.where(F.col("item").isNotNull())
    # a sequence holds a pattern; ``end`` is the earliest place where it can end
    held = steps.groupBy("seq", "w", F.array("item").alias("pattern")).agg(F.min("pos").alias("end"))
    level = frequent(held)
    out, length = level, 1
    items = level.select(F.col("pattern")[0].alias("item"))
    steps = measured(steps.join(items, "item", "left_semi"), "steps")
    while (max_length is None or length < max_length) and not level.isEmpty():
        held = measured(held.join(level.select("pattern"), "pattern", "left_semi"), "held")
        h, s = held.alias("h"), steps.alias("s")
        after = h.join(s, (F.col("h.seq") == F.col("s.seq")) & (F.col("s.pos") > F.col("h.end")))
        held = after.groupBy("h.seq", "h.w", F.concat("h.pattern", F.array("s.item")).alias("pattern")).agg(
            F.min("s.pos").alias("end")
        )
        level = frequent(held)
        out, length = out.unionByName(level), length + 1
    return out.select("pattern", F.col("freq").cast("long").alias("freq"))


def longest_patterns(patterns: DataFrame, k: int = 10) -> DataFrame:
    """K3: the first ``k`` patterns by length, then support (both descending; ties
    by the text), with their ``rank``."""
    text = patterns_as_text(patterns)
    order = [F.col("length").desc(), F.col("freq").desc(), F.col("pattern")]
    top = text.orderBy(*order).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # k rows


def top_itemsets(itemsets: DataFrame, k: int = 10) -> DataFrame:
    """M6: the ``k`` itemsets of highest support (ties by the text), with their ``rank``."""
    text = itemsets.select(items_text("items").alias("items"), "freq", "support")
    order = [F.col("freq").desc(), F.col("items")]
    return text.orderBy(*order).limit(k).withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # k rows


def patterns_as_text(p: DataFrame, sep: str = " > ") -> DataFrame:
    return p.select(F.array_join("pattern", sep).alias("pattern"), F.size("pattern").alias("length"), "freq")
