"""CSV type inference and file order against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sifter.operators import features
from sifter.sources import files

COLUMNS = [
    ["1", "2"], ["1", ""], ["99999999999999999999", "1"], ["1.5", "2"], ["18446744073709551615", "1"], ["-1", "18446744073709551615"],
    ["True", "false"], ["True", ""], ["True", "1"], ["1", "1.5"], ["inf", "1"], ["1e5", "2"], [" 5", "6"], ["NA", "NA"], ["+5", "6"],
    ["0x10", "1"], ["1_0", "2"], ["tRue", "FALSE"], ["5.", "2"], [".5", "2"], ["1d5", "2"], ["1E+3", "2"], ["-Infinity", "1"],
    ["9223372036854775808", "1"], ["infinit", "1"], ["+inf", "1"], ["007", "1"], ["5 5", "1"], ["", "nan"], ["True", "NA"], ["-", "1"],
    ["2020-01-01", "2020-01-02"], ["é", "ü"], ["9223372036854775807", "-9223372036854775808"], ["NaN", "1"], [" NA", "1"],
]
KINDS = {"int64": "bigint", "float64": "double", "uint64": "decimal(20,0)", "bool": "boolean", "object": "string", "str": "string"}


def same(a, b):
    return (a is None and (b is None or b != b)) or a == b


def test_types_and_values_as_pandas(spark, tmp_path):
    path = f"{tmp_path}/a.csv"
    names = [f"c{i}" for i in range(len(COLUMNS))] + ["x.y", "dup licate"]
    rows = list(zip(*COLUMNS, ["1", "2"], ["a", "b"]))
    with open(path, "w") as f:
        f.write("\n".join(",".join(r) for r in [names, *rows]) + "\n")
    want = pd.read_csv(path)
    got = files.read_csv(spark, path)
    assert got.columns == names
    for name, kind in got.dtypes:
        assert kind == KINDS[str(want[name].dtype)], (name, kind, want[name].dtype)
    for r, (_, w) in zip(got.collect(), want.iterrows()):
        for name, a, b in zip(names, r, w):
            assert same(a, b.item() if isinstance(b, np.generic) else b) or str(a) == str(b), (name, a, b)


def test_no_rows_and_all_null(spark, tmp_path):
    (tmp_path / "none.csv").write_text("a,b\n")
    assert files.read_csv(spark, f"{tmp_path}/none.csv").dtypes == [("a", "string"), ("b", "string")]
    (tmp_path / "null.csv").write_text("a,b\nNA,1\n,2\n")
    got = files.read_csv(spark, f"{tmp_path}/null.csv")
    assert got.dtypes == [("a", "double"), ("b", "bigint")] and got.collect()[0].a is None
    (tmp_path / "empty.csv").write_text("")
    assert files.infer_schema(spark, f"{tmp_path}/empty.csv").names == []


def test_counters_add_up_over_files(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "1.csv").write_text("a,b\n1,1\n2,2\n")
    (tmp_path / "t" / "2.csv").write_text("a,b\n3,x\n4.5,4\n")
    assert files.read_csv(spark, f"{tmp_path}/t").dtypes == [("a", "double"), ("b", "string")]


@pytest.mark.parametrize("size", ["1k", "1m"])
def test_file_order_and_first_seen_codes(spark, tmp_path, size):
    rng = np.random.default_rng(4)
    frames = [pd.DataFrame({"n": range(k * 1000, k * 1000 + 700), "v": rng.choice(["b", "a", "z", "m", None], 700), "w": rng.integers(0, 400, 700)}) for k in range(3)]
    for k, frame in enumerate(frames):
        frame.sample(frac=1, random_state=k).to_csv(f"{tmp_path}/f{k}.csv", index=False)
    want = pd.concat([pd.read_csv(f"{tmp_path}/f{k}.csv") for k in range(3)], ignore_index=True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        rows = files.read_csv_in_order(spark, str(tmp_path))
        if size == "1k":
            assert spark.read.csv(str(tmp_path)).rdd.getNumPartitions() > 10
        out = features.factorize(rows, ["v", "w"], "_code", files.ROW_INDEX).orderBy(files.ROW_INDEX).toPandas()
        first = files.head(spark.read.option("header", True).csv(str(tmp_path)), 4).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert out["row_index"].tolist() == list(range(2100)) and out["n"].tolist() == want["n"].tolist()
    for c in ("v", "w"):
        assert out[f"{c}_code"].tolist() == pd.factorize(want[c])[0].tolist()
    assert [int(r.n) for r in first] == want["n"].tolist()[:4]


def test_category_codes_of_many_levels(spark):
    df = spark.range(200_000).select("id", F.concat(F.lit("v"), F.col("id") % 150_000).alias("c"))
    codes = features.CategoryCodes(df.where("id < 100000"), ["c"])
    out = codes.transform(df)
    assert out.columns == ["id", "c", "c_code"] and codes.sizes == {"c": 100_000}
    assert out.where("c_code = 100000").count() == 50_000 and out.agg(F.countDistinct("c_code")).first()[0] == 100_001
    assert out.where("c = 'v0'").first().c_code == 0.0
