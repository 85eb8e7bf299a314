"""Expression helpers (all JVM-side ``pyspark.sql.functions``)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Labels that must read exactly as in the reference outputs.
# ---------------------------------------------------------------------------
LABELS_5 = ["Muito Baixo", "Baixo", "Medio", "Alto", "Muito Alto"]
LABELS_7 = ["Mto Baixo", "Baixo", "Medio-Baixo", "Medio", "Medio-Alto", "Alto", "Mto Alto"]
GENERIC_LABEL = "Nivel {i}"          # any other bin count, i = 1..bins
TIER_LABEL = "NB_Level_{i}"          # group price tiers, i = 1..bins
DECILE_LABEL = "D{i}"                # error deciles, i = 1..10
SEGMENT_LABEL = "Segment_{i}"        # k-means segments
NA_TEXT = "NA"                       # "feature absent" text fill
MISSING_TEXT = "missing"             # placeholder category before scoring
NULL_ITEM_TEXT = "nan"               # how a null renders inside an item string
# The texts pandas reads as null by default.
NULL_SENTINELS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def bin_labels(bins: int) -> list[str]:
    if bins == 5:
        return list(LABELS_5)
    if bins == 7:
        return list(LABELS_7)
    return [GENERIC_LABEL.format(i=i) for i in range(1, bins + 1)]


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def q(name: str) -> str:
    """Back-quote a column name for SQL text (names like ``1stFlrSF``)."""
    return "`" + name.replace("`", "``") + "`"


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 int where null (a NaN comparison in pandas) counts as false."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def null_false(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def sum_cols(cols: Iterable[str | Column]) -> Column:
    return reduce(lambda a, b: a + b, [col(c) for c in cols])


def bin_index(x: str | Column, interior_edges: Sequence[float]) -> Column:
    """Right-closed bin number (1-based): ``1 + #(interior edges < x)``.

    The outer edges never matter for values inside the fitted range, which is
    where pandas' ``cut``/``qcut`` place every fitted value.  Null stays null.
    """
    x = col(x)
    if not interior_edges:
        return F.when(x.isNotNull(), F.lit(1))
    return F.when(x.isNotNull(), 1 + sum_cols([(x > F.lit(float(e))).cast("int") for e in interior_edges]))


def label_of(idx: Column, labels: Sequence[str]) -> Column:
    """1-based label lookup; a null index gives null (``element_at`` with a null
    index is not null-safe here, so it is guarded)."""
    return F.when(idx.isNotNull(), F.element_at(F.array(*[F.lit(s) for s in labels]), idx.cast("int")))


def equal_width_edges(mn: float, mx: float, bins: int) -> list[float]:
    """Edges of ``pandas.cut(x, bins)``: linspace, lowest edge widened by 0.1 % of
    the range; a constant column widens both ends by 0.1 % of |value|."""
    if mn == mx:
        adj = 0.001 * abs(mn) if mn != 0 else 0.001
        mn, mx = mn - adj, mx + adj
        step = (mx - mn) / bins
        edges = [i * step + mn for i in range(bins + 1)]
        edges[-1] = mx
        return edges
    step = (mx - mn) / bins
    edges = [i * step + mn for i in range(bins + 1)]
    edges[-1] = mx
    edges[0] = edges[0] - (mx - mn) * 0.001
    return edges


def sample_skew(g1: Column, n: Column) -> Column:
    """Bias-corrected skewness from Spark's population skewness."""
    n = n.cast("double")
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurt(g2: Column, n: Column) -> Column:
    """Bias-corrected excess kurtosis from Spark's population excess kurtosis."""
    n = n.cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def item(name: str, value: Column) -> Column:
    """``"col=value"`` item; a null value renders like pandas' ``str(nan)``."""
    return F.concat(F.lit(f"{name}="), F.coalesce(value.cast("string"), F.lit(NULL_ITEM_TEXT)))


def safe_corr(a: str | Column, b: str | Column) -> Column:
    """Pearson r over pairwise-complete rows; a constant side gives null (as
    pandas' NaN) instead of a division-by-zero error under ANSI mode."""
    a, b = col(a).cast("double"), col(b).cast("double")
    a2 = F.when(b.isNotNull(), a)
    b2 = F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(a2, b2), F.stddev_pop(a2) * F.stddev_pop(b2))
