"""File sources and sinks (A1-A5)."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sifter.functions.exprs import NULL_SENTINELS
from sifter.operators.ranks import measured


def _as_struct(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


#: Spellings of numbers, as pandas reads them; white space around is allowed.
INTEGER = r"^\s*[+-]?[0-9]+\s*$"
REAL = r"^\s*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"
BOOLEAN = r"^(?i:true|false)$"
#: Counters of a column's texts; those of two parts of a file add up, or take the greater one.
COUNTERS = ["n", "n_null", "n_bool", "n_int", "n_long", "n_ulong", "n_real"]
TYPES = {"bool": T.BooleanType(), "int": T.LongType(), "uint": T.DecimalType(20, 0), "double": T.DoubleType(), "text": T.StringType()}


def _counters(c: Column, sentinels: Sequence[str]) -> list[Column]:
    value = F.when(~c.isin(*sentinels), c)
    whole = value.rlike(INTEGER)
    number = F.when(whole, F.trim(value).try_cast(T.DecimalType(38, 0)))
    tests = [
        value.isNull(), value.rlike(BOOLEAN), whole, number.between(Decimal(-(2**63)), Decimal(2**63 - 1)),
        number.between(Decimal(0), Decimal(2**64 - 1)), value.rlike(REAL),
    ]
    return [F.count(F.lit(1)), *(F.count(F.when(t, 1)) for t in tests)]


def _kind() -> Column:
    """The least type that holds every text of a column, from its counters: bool; int; uint; double; text.

    As in pandas, nulls turn integers into doubles and booleans into text, a column of nulls alone is
    double, and a column without rows is text; integers beyond 64 bits are text."""
    known = F.col("n") - F.col("n_null")
    return (
        F.when(F.col("n") == 0, "text").when(known == 0, "double")
        .when((F.col("n_bool") == known) & (F.col("n_null") == 0), "bool")
        .when((F.col("n_int") == known) & (F.col("n_long") < known) & (F.col("n_ulong") < known), "text")
        .when((F.col("n_int") == known) & (F.col("n_null") > 0), "double")
        .when(F.col("n_long") == known, "int").when(F.col("n_ulong") == known, "uint")
        .when(F.col("n_real") == known, "double").otherwise("text")
    )


def text_profile(raw: DataFrame, sentinels: Sequence[str] = NULL_SENTINELS) -> DataFrame:
    """A row a column of a table of texts: name, COUNTERS and ``type`` (a key of TYPES). One
    aggregation over all columns, whose counters are mergeable, so every task sends one row."""
    name = lambda c: "`" + c.replace("`", "``") + "`"
    counts = [F.struct(*(x.alias(k) for k, x in zip(COUNTERS, _counters(F.col(name(c)), sentinels)))).alias(f"c{i}") for i, c in enumerate(raw.columns)]
    row = raw.agg(*counts)
    cells = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("name"), F.col(f"c{i}").alias("c")) for i, c in enumerate(raw.columns)])
    return row.select(F.inline(cells)).select("position", "name", "c.*").withColumn("type", _kind())


def _raw_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def infer_schema(spark: SparkSession, path: str, sentinels: Sequence[str] = NULL_SENTINELS) -> T.StructType:
    """The types of a header CSV's columns, by all its rows (``text_profile``)."""
    raw = _raw_csv(spark, path)
    if not raw.columns:
        return T.StructType([])
    found = sorted(text_profile(raw, sentinels).collect(), key=lambda r: r["position"])
    return T.StructType([T.StructField(r["name"], TYPES[r["type"]], True) for r in found])


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, sentinels: Sequence[str] = NULL_SENTINELS,
    also: Sequence[Column] = (),
) -> DataFrame:
    """A1: header CSV; every sentinel in ``sentinels`` (pandas' default list)
    becomes null, then columns are cast to a declared schema, or to the one that
    a first pass over the texts infers.

    Spark's ``nullValue`` takes a single string, so the file is read as text,
    sentinels are nulled and the casts run in the same projection. ``also``
    adds columns of the scan's own, such as its metadata.
    """
    st = infer_schema(spark, path, sentinels) if schema is None else _as_struct(schema)
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in st.fields])
    raw = _raw_csv(spark, path, text)

    def value(f: T.StructField):
        c = F.col("`" + f.name.replace("`", "``") + "`")
        known = F.when(c.isin(*sentinels), F.lit(None)).otherwise(c)
        x = known if isinstance(f.dataType, T.StringType) else F.trim(known).cast(f.dataType)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            x = F.when(~F.isnan(x), x)  # other spellings of NaN are null too
        return x.alias(f.name)

    return raw.select(*[value(f) for f in st.fields], *also)


ROW_INDEX = "row_index"


def with_row_index(scan: DataFrame, out: str = ROW_INDEX, path: str = "_metadata.file_path", start: str = "_metadata.file_block_start") -> DataFrame:
    """Rows of a file scan with their number in file order, from 0: files by path, then the split's
    offset in the file, then the place in the split.

    A row is numbered inside its split, splits are counted, and each is offset by the rows before it:
    prefix sums over the splits, whose table has a row a split. The scan is written once with the
    numbers, so both steps see the same splits."""
    kept = [F.col("`" + c.replace("`", "``") + "`") for c in scan.columns]
    rows = scan.select(F.struct(*kept).alias("row"), F.col(path).alias("file"), F.col(start).alias("start"), F.monotonically_increasing_id().alias("at"))
    rows = measured(rows, "row-index")
    splits = rows.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    files = splits.groupBy("file").agg(F.sum("n").alias("n"))
    by_start = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    by_file = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    files = files.select("file", F.coalesce(F.sum("n").over(by_file), F.lit(0)).alias("files_before"))
    splits = splits.withColumn("before", F.coalesce(F.sum("n").over(by_start), F.lit(0))).join(files, "file")
    offsets = measured(splits.select("file", "start", (F.col("before") + F.col("files_before") - F.col("first")).alias("offset")), "row-offsets")
    return rows.join(offsets, ["file", "start"]).select("row.*", (F.col("at") + F.col("offset")).alias(out))


def read_csv_in_order(spark: SparkSession, path: str, schema: T.StructType | str | None = None, sentinels: Sequence[str] = NULL_SENTINELS, out: str = ROW_INDEX) -> DataFrame:
    """A1 with each row's number in file order in ``out``."""
    place = [F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_block_start").alias("__start")]
    typed = read_csv(spark, path, schema, sentinels, also=place)
    rows = with_row_index(typed, out, "__path", "__start")
    return rows.drop("__path", "__start")


def read_or_empty(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "csv", **kw
) -> DataFrame:
    """A2: a missing source yields an empty frame (callers test ``isEmpty()``)."""
    try:
        if fmt == "csv":
            df = read_csv(spark, path, schema, **kw)
        else:
            df = spark.read.schema(_as_struct(schema)).format(fmt).load(path)
        df.schema  # noqa: B018 - resolve the path now
        return df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], _as_struct(schema))
        raise


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A3: header CSV, no index column; nulls written as empty fields."""
    df.write.mode(mode).option("header", True).csv(path)


def head(scan: DataFrame, n: int = 5) -> DataFrame:
    """A4: the first ``n`` rows in file order."""
    return with_row_index(scan).orderBy(ROW_INDEX).limit(n).drop(ROW_INDEX)


def preview(df: DataFrame, key: str | Sequence[str], n: int = 5) -> DataFrame:
    """A4: first ``n`` rows by key (a bounded TakeOrderedAndProject)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(*keys).limit(n)


def shape(df: DataFrame) -> DataFrame:
    """A5: one-row ``(n_rows, n_cols)``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("long"))
