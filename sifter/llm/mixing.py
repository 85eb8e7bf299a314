"""Mixing sources to target weights: entropy balancing.

Document rates r minimise the divergence sum of size * (r ln r - r + 1) under token constraints:
the words taken from each source equal its target, and their mean log size stays the source's own
(a mix must not buy words with longer or shorter documents). The solution is an exponential tilt,
r = min(3, exp(a + b * z)), with z the source-centred log size; (a, b) solve the convex dual by
Newton steps whose gradient and Hessian are Spark aggregates by source. Documents of equal source
and size have equal rates, so all passes but the first run over the counts by (source, size).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialise, number_rows

#: No document is taken more often.
MAX_COPIES = 3
NEWTON_STEPS = 12
REPAIRS = 4


def targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``sources``: one row a source (source, source_size). Adds ``weight`` and ``target``.

    Sources in code-point order, null last, weigh ``weights`` in turn and share all sizes; a target
    stops at MAX_COPIES times its source's size, the excess goes to the others by weight until none
    is above. The fixed point is the largest level L with target = min(cap, L * weight) and the sum
    as given: sources are capped in the order of cap / weight, so one running sum finds L.
    """
    # one row a source: a table of names, not of documents
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (turn + 1).cast("int"))
    rows = sources.withColumn("weight", w).withColumn("cap", F.col("source_size") * float(MAX_COPIES))
    rows = rows.withColumn("ratio", F.col("cap") / F.col("weight"))
    run = Window.orderBy("ratio").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rows = (
        rows.withColumn("cap_sum", F.sum("cap").over(run))
        .withColumn("weight_sum", F.sum("weight").over(run))
        .withColumn("all_weight", F.sum("weight").over(Window.partitionBy()))
        .withColumn("all_size", F.sum("source_size").over(Window.partitionBy()).cast("double"))
    )
    # level if the sources up to this one are capped and all others are not; caps hold while they
    # lie below their share of that level
    left = F.col("all_weight") - F.col("weight_sum")
    level = F.when(left > 0, (F.col("all_size") - F.col("cap_sum")) / left)
    capped = F.col("ratio") <= level
    rows = rows.withColumn("level", F.max(F.when(capped, level)).over(Window.partitionBy()))
    rows = rows.withColumn("level", F.coalesce("level", F.col("all_size") / F.col("all_weight")))
    return rows.withColumn("target", F.least("cap", F.col("level") * F.col("weight"))).select(
        "source", "source_size", "weight", "target"
    )


def newton(cells: DataFrame, goals: DataFrame) -> DataFrame:
    """Dual variables by source. ``cells``: (source, size, z, n); ``goals``: (source, source_size,
    target, z2), z2 being the size-weighted mean square of z. Null-safe in ``source``."""
    duals = goals.withColumns({"a": F.lit(0.0), "b": F.lit(0.0)})
    for step in range(NEWTON_STEPS):
        d = materialise(duals, "mix-dual")
        rate = F.exp(F.least(F.col("d.a") + F.col("d.b") * F.col("c.z"), F.lit(20.0)))
        rate = F.least(rate, F.lit(float(MAX_COPIES)))
        words = F.col("c.size") * F.col("c.n") * rate
        free = F.when(rate < MAX_COPIES, words).otherwise(F.lit(0.0))  # capped rates have no slope
        z = F.col("c.z")
        c = cells.alias("c").join(d.alias("d"), F.col("c.source").eqNullSafe(F.col("d.source")))
        sums = c.groupBy(F.col("c.source").alias("source")).agg(
            F.sum(words).alias("g"),
            F.sum(words * z).alias("gz"),
            F.sum(free).alias("h"),
            F.sum(free * z).alias("hz"),
            F.sum(free * z * z).alias("hzz"),
        )
        joined = d.alias("d").join(sums.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
        miss, miss_z = F.col("target") - F.col("g"), -F.col("gz")
        det = F.col("h") * F.col("hzz") - F.col("hz") * F.col("hz")
        flat = (det <= 1e-9 * F.col("h") * F.col("h")) | (F.col("target") >= MAX_COPIES * F.col("source_size") * 0.999)
        # Newton's step, damped as if the gradient were linear in ln: exact where no rate is capped
        over = F.try_divide(F.col("target"), F.col("g"))
        damp = F.when(F.abs(over - 1) < 1e-6, 1.0).otherwise(F.ln(over) / (over - 1))
        da = F.when(flat, miss / F.col("h")).otherwise((miss * F.col("hzz") - miss_z * F.col("hz")) / det)
        db = F.when(flat, 0.0).otherwise((miss_z * F.col("h") - miss * F.col("hz")) / det)
        # without slope (no words, or all rates capped) start anew just below the cap
        stuck, empty = F.col("h") <= 0, F.col("g") <= 0
        da = F.when(empty, 0.0).when(stuck, F.log(F.lit(float(MAX_COPIES))) + F.ln(over) - F.col("d.a")).otherwise(da * damp)
        db = F.when(empty, 0.0).when(stuck, -F.col("d.b")).otherwise(db * damp)
        done = F.max(F.abs(miss) / F.greatest("target", F.lit(1.0)))
        worst = joined.agg(done.alias("w")).first()["w"]
        duals = joined.select(
            *(F.col(f"d.{x}").alias(x) for x in goals.columns),
            (F.col("d.a") + F.greatest(F.least(da, F.lit(2.0)), F.lit(-2.0))).alias("a"),
            (F.col("d.b") + F.greatest(F.least(db, F.lit(1.0)), F.lit(-1.0))).alias("b"),
        )
        if worst is None or worst < 1e-9:
            return d
    return materialise(duals, "mix-dual")


def entropy_mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", whole: bool = False
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, rate, copies, taken;
    with ``whole`` instead the mix itself, every row of ``docs`` as often as it is taken.

    size: words of the text (null: 0). Copies are 0 to MAX_COPIES; taken = copies * size. Rounding
    keeps floor(rate) copies and deals the rest by systematic sampling in the order of size, so a
    source misses its target by one document's words at most; then single copies are added or
    taken back while that lessens the miss. Documents are chosen by the hash of their id, so reruns
    agree. Null sources form a source of their own, last in order; a source without words has
    target 0; documents without words are copied at their rate like the rest and take nothing.
    Rows that repeat are documents of their own (which of several equal rows gets a copy is not
    fixed). An empty table gives an empty result.
    """
    needed = [
        F.col(doc_id).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    ]
    base = materialise(docs.select(*needed), "mix-base")
    cells = base.groupBy("source", "size").agg(F.count("*").alias("n"))
    cells = cells.withColumn("log", F.log1p(F.col("size").cast("double")))
    words = F.col("size") * F.col("n")
    stats = cells.groupBy("source").agg(
        F.sum(words).cast("long").alias("source_size"), F.sum(words * F.col("log")).alias("logs")
    )
    stats = stats.withColumn("mean", F.coalesce(F.try_divide("logs", "source_size"), F.lit(0.0))).drop("logs")
    goals = materialise(
        targets(stats.select("source", "source_size"))
        .alias("t")
        .join(stats.alias("s"), F.col("t.source").eqNullSafe(F.col("s.source")))
        .select("t.*", "s.mean"),
        "mix-goals",
    )
    cells = materialise(
        cells.alias("c")
        .join(goals.alias("g"), F.col("c.source").eqNullSafe(F.col("g.source")))
        .select("c.source", "c.size", "c.n", (F.col("c.log") - F.col("g.mean")).alias("z")),
        "mix-cells",
    )
    duals = newton(cells, goals)

    c, d = cells.alias("c"), duals.alias("d")
    rate = F.least(F.exp(F.least(F.col("d.a") + F.col("d.b") * F.col("c.z"), F.lit(20.0))), F.lit(float(MAX_COPIES)))
    full = F.col("d.target") >= MAX_COPIES * F.col("d.source_size") * (1 - 1e-12)
    plan = c.join(d, F.col("c.source").eqNullSafe(F.col("d.source"))).select(
        "c.source", "c.size", "c.n", "d.source_size", "d.target", F.when(full, float(MAX_COPIES)).otherwise(rate).alias("rate")
    )
    # systematic sampling over the counts: cell by cell in the order of size
    run = Window.partitionBy("source").orderBy("size")
    part = F.col("rate") - F.floor("rate")
    plan = plan.withColumn("end", F.sum(F.col("n") * part).over(run))
    start = F.floor(F.col("end") - F.col("n") * part + 0.5)
    extra = F.greatest(F.lit(0), F.least(F.col("n"), (F.floor(F.col("end") + 0.5) - start).cast("long")))
    plan = plan.withColumn("copies", F.floor("rate").cast("long") * F.col("n") + extra).drop("end")
    for turn in range(REPAIRS):
        plan = repair(materialise(plan, "mix-plan"))
    plan = materialise(plan, "mix-plan")

    if whole:
        base = docs.select(*needed, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    numbered = number_rows(base, ["source", "size"], ["doc_id"], "k").alias("b")
    p = plan.alias("p")
    on = F.col("b.source").eqNullSafe(F.col("p.source")) & (F.col("b.size") == F.col("p.size"))
    low = F.floor(F.col("p.copies") / F.col("p.n"))
    copies = (low + (F.col("b.k") < F.col("p.copies") - low * F.col("p.n")).cast("long")).cast("long")
    if whole:
        taken = numbered.join(p, on).select("b.row", copies.alias("copies")).where("copies > 0")
        return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")
    return numbered.join(p, on).select(
        "b.doc_id",
        "b.source",
        "b.size",
        "p.source_size",
        "p.target",
        "p.rate",
        copies.alias("copies"),
        (copies * F.col("b.size")).cast("long").alias("taken"),
    )


def repair(plan: DataFrame) -> DataFrame:
    """Add or take back one copy a source, of the size nearest the miss, if that lessens it."""
    miss = F.col("target") - F.col("got")
    sums = plan.groupBy("source").agg(
        F.sum(F.col("copies") * F.col("size")).alias("got"), F.first("target").alias("goal")
    )
    p, s = plan.alias("p"), sums.alias("s")
    joined = p.join(s, F.col("p.source").eqNullSafe(F.col("s.source"))).select("p.*", "s.got")
    may = F.when(miss > 0, F.col("copies") < F.col("n") * MAX_COPIES).otherwise(F.col("copies") > 0)
    after = F.abs(F.abs(miss) - F.col("size"))
    better = may & (F.col("size") > 0) & (after < F.abs(miss))
    best = joined.where(better).groupBy("source").agg(
        F.min(F.struct(after.alias("after"), "size", F.signum(miss).cast("long").alias("sign"))).alias("best")
    )
    j, b = joined.alias("j"), best.alias("b")
    hit = F.col("j.size") == F.col("b.best.size")
    return j.join(b, F.col("j.source").eqNullSafe(F.col("b.source")), "left").select(
        *(F.col(f"j.{x}") for x in plan.columns if x != "copies"),
        (F.col("j.copies") + F.when(hit, F.col("b.best.sign")).otherwise(F.lit(0))).alias("copies"),
    )
