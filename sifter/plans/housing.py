"""The house-price discovery flow on the house-sale table (FIXTURES.md §1).

This is the reference's end-to-end use, phase by phase, written with the
operators of this package: every step is a Spark plan over the whole table;
only fit statistics (edges, medians, modes, model parameters) are small.

    phase 1  read (CSV with NA sentinels) -> outlier removal (rule u forest)
    phase 2  clean/impute -> neighbourhood price tiers -> 16 features
    phase 3  mutual information, correlations, relation and distribution reports
    phase 4  segments, discretization, rules, row patterns, evolution patterns
    phase 5  tree model: CV, hold-out with early stopping, importances, error by decile
    phase 6  score the test table with the training fit, write the submission

Console banners, plots and the text log of the reference are not built; each
report is a DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.functions.exprs import NA_TEXT, flag, safe_corr
from sifter.operators import binning, dependence, features, impute, joins, models, outliers, patterns, profile
from sifter.operators.columns import align_columns, numeric_columns, present, text_columns
from sifter.operators.ranks import measured, modes
from sifter.sources import files

# ---------------------------------------------------------------------------
# Column lists, maps and thresholds that must equal the
# reference's for the same results.
# ---------------------------------------------------------------------------
ABSENT_MEANS_NA = [
    "Alley", "BsmtQual", "BsmtCond", "BsmtExposure", "BsmtFinType1", "BsmtFinType2", "FireplaceQu",
    "GarageType", "GarageFinish", "GarageQual", "GarageCond", "PoolQC", "Fence", "MiscFeature", "MasVnrType",
]
MODE_FILL = ["Electrical", "MSZoning", "Utilities", "Exterior1st", "Exterior2nd", "KitchenQual", "SaleType", "Functional"]
OUTLIER_RULE = {"GrLivArea": 4000, "LotArea": 100000}
FOREST_COLUMNS = ["GrLivArea", "TotalBsmtSF", "1stFlrSF", "GarageArea", "LotArea", "SalePrice"]
NEGATIVE_AMENITIES = ["Artery", "Feedr", "RRNn", "RRAn", "RRNe", "RRAe"]
CRITICAL_ZONES = ["C (all)", "RM"]
ABNORMAL_SALES = ["Abnorml", "AdjLand"]
DEFAULT_REFERENCE_YEAR = 2010
DISTRESSED_BELOW = 4  # condition and quality
OLD_BEFORE, HIGH_CONDITION = 1950, 7
ORDINAL_MAPS = {
    "LotShape": {"Reg": 3, "IR1": 2, "IR2": 1, "IR3": 0},
    "Utilities": {"AllPub": 3, "NoSewr": 2, "NoSeWa": 1, "ELO": 0},
    "LandSlope": {"Gtl": 2, "Mod": 1, "Sev": 0},
    "ExterQual": {"Ex": 4, "Gd": 3, "TA": 2, "Fa": 1, "Po": 0},
    "ExterCond": {"Ex": 4, "Gd": 3, "TA": 2, "Fa": 1, "Po": 0},
    "BsmtQual": {"Ex": 5, "Gd": 4, "TA": 3, "Fa": 2, "Po": 1, "NA": 0},
    "BsmtCond": {"Ex": 5, "Gd": 4, "TA": 3, "Fa": 2, "Po": 1, "NA": 0},
    "BsmtExposure": {"Gd": 4, "Av": 3, "Mn": 2, "No": 1, "NA": 0},
    "BsmtFinType1": {"GLQ": 6, "ALQ": 5, "BLQ": 4, "Rec": 3, "LwQ": 2, "Unf": 1, "NA": 0},
    "BsmtFinType2": {"GLQ": 6, "ALQ": 5, "BLQ": 4, "Rec": 3, "LwQ": 2, "Unf": 1, "NA": 0},
    "HeatingQC": {"Ex": 4, "Gd": 3, "TA": 2, "Fa": 1, "Po": 0},
    "KitchenQual": {"Ex": 4, "Gd": 3, "TA": 2, "Fa": 1, "Po": 0},
    "Functional": {"Typ": 7, "Min1": 6, "Min2": 5, "Mod": 4, "Maj1": 3, "Maj2": 2, "Sev": 1, "Sal": 0},
    "FireplaceQu": {"Ex": 5, "Gd": 4, "TA": 3, "Fa": 2, "Po": 1, "NA": 0},
    "GarageFinish": {"Fin": 3, "RFn": 2, "Unf": 1, "NA": 0},
    "GarageQual": {"Ex": 5, "Gd": 4, "TA": 3, "Fa": 2, "Po": 1, "NA": 0},
    "GarageCond": {"Ex": 5, "Gd": 4, "TA": 3, "Fa": 2, "Po": 1, "NA": 0},
    "PavedDrive": {"Y": 2, "P": 1, "N": 0},
    "PoolQC": {"Ex": 4, "Gd": 3, "TA": 2, "Fa": 1, "NA": 0},
    "Fence": {"GdPrv": 4, "MnPrv": 3, "GdWo": 2, "MnWw": 1, "NA": 0},
}
REQUESTED_DISTRIBUTIONS = ["BsmtQual", "KitchenQual", "1stFlrSF", "GarageCars", "TotalBathrooms", "CentralAir",
                           "Fireplaces", "OverallCond"]
# run parameters of the reference flow
TIER_BINS = 5
SEGMENTS = 5
RULE_SUPPORT, RULE_CONFIDENCE, RULE_MAX_LEN = 0.08, 0.75, 5
ROW_PATTERN_RATIO = 0.1
EVOLUTION_RATIO = 0.2
TARGET = "SalePrice"
KEY = "Id"

# declared schema (FIXTURES.md §1): double where nulls occur, else bigint/string
_BIGINT = [
    "MSSubClass", "LotArea", "OverallQual", "OverallCond", "YearBuilt", "YearRemodAdd", "1stFlrSF", "2ndFlrSF",
    "LowQualFinSF", "GrLivArea", "FullBath", "HalfBath", "BedroomAbvGr", "KitchenAbvGr", "TotRmsAbvGrd",
    "Fireplaces", "WoodDeckSF", "OpenPorchSF", "EnclosedPorch", "3SsnPorch", "ScreenPorch", "PoolArea",
    "MiscVal", "MoSold", "YrSold",
]
_DOUBLE = [
    "LotFrontage", "MasVnrArea", "BsmtFinSF1", "BsmtFinSF2", "BsmtUnfSF", "TotalBsmtSF", "BsmtFullBath",
    "BsmtHalfBath", "GarageYrBlt", "GarageCars", "GarageArea", "SalePrice",
]
HOUSE_COLUMNS = [
    "Id", "MSSubClass", "MSZoning", "LotFrontage", "LotArea", "Street", "Alley", "LotShape", "LandContour",
    "Utilities", "LotConfig", "LandSlope", "Neighborhood", "Condition1", "Condition2", "BldgType",
    "HouseStyle", "OverallQual", "OverallCond", "YearBuilt", "YearRemodAdd", "RoofStyle", "RoofMatl",
    "Exterior1st", "Exterior2nd", "MasVnrType", "MasVnrArea", "ExterQual", "ExterCond", "Foundation",
    "BsmtQual", "BsmtCond", "BsmtExposure", "BsmtFinType1", "BsmtFinSF1", "BsmtFinType2", "BsmtFinSF2",
    "BsmtUnfSF", "TotalBsmtSF", "Heating", "HeatingQC", "CentralAir", "Electrical", "1stFlrSF", "2ndFlrSF",
    "LowQualFinSF", "GrLivArea", "BsmtFullBath", "BsmtHalfBath", "FullBath", "HalfBath", "BedroomAbvGr",
    "KitchenAbvGr", "KitchenQual", "TotRmsAbvGrd", "Functional", "Fireplaces", "FireplaceQu", "GarageType",
    "GarageYrBlt", "GarageFinish", "GarageCars", "GarageArea", "GarageQual", "GarageCond", "PavedDrive",
    "WoodDeckSF", "OpenPorchSF", "EnclosedPorch", "3SsnPorch", "ScreenPorch", "PoolArea", "PoolQC", "Fence",
    "MiscFeature", "MiscVal", "MoSold", "YrSold", "SaleType", "SaleCondition", "SalePrice",
]


def _type(c: str) -> str:
    if c == KEY or c in _BIGINT:
        return "bigint"
    if c in _DOUBLE:
        return "double"
    return "string"


def house_schema(with_target: bool = True) -> str:
    cols = [c for c in HOUSE_COLUMNS if with_target or c != TARGET]
    return ", ".join(f"`{c}` {_type(c)}" for c in cols)


# ---- phase 1 ---------------------------------------------------------------------------
def read_table(spark: SparkSession, path: str, with_target: bool = True) -> DataFrame:
    """A1/A2: declared schema, NA sentinels -> null; a missing file -> empty frame."""
    return files.read_or_empty(spark, path, house_schema(with_target))


def remove_outliers(df: DataFrame, forest: bool = True, trees: int = 100, seed: int = 42) -> DataFrame:
    """Domain rule (``GrLivArea > 4000 or LotArea > 100000``, null compares
    false) union isolation forest (contamination 1 %) -> anti-join."""
    rule = None
    for c, limit in OUTLIER_RULE.items():
        if c in df.columns:
            e = F.col(c) > limit
            rule = e if rule is None else rule | e
    rule = rule if rule is not None else F.lit(False)
    iso = None
    if forest:
        cols = present(df, FOREST_COLUMNS)
        iso = outliers.IsolationForest(cols, trees=trees, contamination=0.01, seed=seed).fit(df, KEY)
    return outliers.remove_outliers(df, KEY, rule, iso)


# ---- phase 2 ---------------------------------------------------------------------------
def clean_and_impute(df: DataFrame) -> DataFrame:
    """C1 -> C3 -> C4 -> C2 -> C5 -> C6: no null leaves this step."""
    out = impute.fill_text(df, ABSENT_MEANS_NA, NA_TEXT)
    out = impute.conditional_fill(out, "GarageYrBlt", "GarageType", NA_TEXT, "YearBuilt")
    out = impute.group_median_fill(out, "LotFrontage", ["Neighborhood"])
    out = impute.fill_number(out, ["MasVnrArea"], 0)
    out = impute.mode_fill(out, present(out, MODE_FILL))
    return impute.global_fallback(out)


def fit_tiers(df: DataFrame, bins: int = TIER_BINS) -> binning.GroupTiers:
    """F8 on the training rows; apply with ``.transform`` to train and test."""
    return binning.fit_group_tiers(df, "Neighborhood", TARGET, bins=bins, out_col="NbPriceTier")


def add_features(df: DataFrame) -> DataFrame:
    """The 16 derived columns in one projection."""
    c = F.col
    has_sold = "YrSold" in df.columns
    new = {
        "TotalSF": features.total("GrLivArea", "TotalBsmtSF"),
        "QualAreaInteract": features.product("OverallQual", "GrLivArea"),
        "TotalBathrooms": features.weighted_sum({"FullBath": 1, "HalfBath": 0.5, "BsmtFullBath": 1, "BsmtHalfBath": 0.5}),
        "HouseAge": features.age(df, "YearBuilt", "YrSold", DEFAULT_REFERENCE_YEAR),
        "YearsSinceRemod": features.age(df, "YearRemodAdd", "YrSold", DEFAULT_REFERENCE_YEAR),
        "IsNewHouse": features.equal_flag("YearBuilt", "YrSold") if has_sold else F.lit(0),
        "TotalPorchSF": features.total("WoodDeckSF", "OpenPorchSF", "EnclosedPorch", "3SsnPorch", "ScreenPorch"),
        "HasPool": features.positive_flag("PoolArea"),
        "Has2ndFloor": features.positive_flag("2ndFlrSF"),
        "HasGarage": features.positive_flag("GarageArea"),
        "HasFireplace": features.positive_flag("Fireplaces"),
        "IsDistressed": flag((c("OverallCond") < DISTRESSED_BELOW) & (c("OverallQual") < DISTRESSED_BELOW)),
        "NearNegativeAmenity": features.member_flag(("Condition1", NEGATIVE_AMENITIES), ("Condition2", NEGATIVE_AMENITIES)),
        "OldHighCond": flag((c("YearBuilt") < OLD_BEFORE) & (c("OverallCond") >= HIGH_CONDITION)),
        "ZoningCrit": features.member_flag(("MSZoning", CRITICAL_ZONES)),
        "IsAbnormalSale": features.member_flag(("SaleCondition", ABNORMAL_SALES)),
    }
    return df.withColumns(new)


# ---- phase 3 ---------------------------------------------------------------------------
def mutual_info_scores(df: DataFrame) -> DataFrame:
    """H6 (binned plug-in estimate) of every column vs the target, sorted."""
    num = numeric_columns(df, exclude=[KEY, TARGET])
    txt = text_columns(df)
    mi = dependence.mutual_information(df, TARGET, num, txt, bins=10)
    return mi.withColumnRenamed("mi", "score")


def correlation_report(df: DataFrame, top_n: int = 15) -> DataFrame:
    """H3: top-n numeric features by |Pearson| vs target, with Spearman."""
    num = numeric_columns(df, exclude=[KEY])
    tc = dependence.target_correlations(df, TARGET, [c for c in num if c != TARGET])
    return dependence.top_by_abs(tc, "pearson", top_n)


def distribution_columns(df: DataFrame, mi: DataFrame) -> tuple[list[str], list[str]]:
    top10 = [r["feature"] for r in profile.top_k(mi, "score", 10, tie=["feature"]).collect()]
    cols = present(df, list(dict.fromkeys(top10 + REQUESTED_DISTRIBUTIONS)))
    nums = set(numeric_columns(df))
    return [c for c in cols if c in nums], [c for c in cols if c not in nums]


# ---- phase 4 ---------------------------------------------------------------------------
def mining_tables(df: DataFrame, mi: DataFrame, seed: int = 42) -> dict[str, DataFrame]:
    """Segments, discretization, target rules, row and evolution patterns."""
    num = numeric_columns(df, exclude=[KEY, TARGET])
    seg = models.kmeans_segments(df, KEY, num, k=SEGMENTS, seed=seed)
    clustered = df.join(seg, KEY)
    plan = binning.fit_discretize(clustered, target=TARGET, bins=5, id_col=KEY)
    disc = plan.transform(clustered)
    ranked = [r["feature"] for r in profile.top_k(mi, "score", 20, tie=["feature"]).collect()]
    cols = list(dict.fromkeys(ranked + [f"{TARGET}Bin", "MarketSegment", "NbPriceTier"]))
    tx = patterns.transactions(disc, present(disc, cols), KEY)
    itemsets = patterns.frequent_itemsets(tx, RULE_SUPPORT, RULE_MAX_LEN)
    rules = patterns.association_rules(itemsets, RULE_CONFIDENCE)
    target_rules = patterns.association_rules(itemsets, RULE_CONFIDENCE, consequent_prefix=f"{TARGET}Bin=")
    top10 = sorted(dict.fromkeys(ranked[:10] + ["MarketSegment", "NbPriceTier"]))
    seqs = patterns.row_sequences(disc, present(disc, top10), KEY)
    seqs = seqs.groupBy("sequence").agg(F.count(F.lit(1)).alias("w"))  # equal rows once
    steps = seqs.select(F.col("sequence").alias("sid"), "w", F.posexplode("sequence").alias("pos", "it"))
    row_patterns = patterns.sequential_patterns(steps, "sid", ["pos"], "it", ROW_PATTERN_RATIO, weight_col="w")
    evolution = evolution_patterns(disc.drop("YearBuilt").join(df.select(KEY, "YearBuilt"), KEY))
    return {
        "segments": seg, "discretized": disc, "itemsets": itemsets, "rules": rules,
        "target_rules": target_rules, "row_patterns": row_patterns, "evolution": evolution,
        "top_itemsets": patterns.top_itemsets(itemsets), "longest_row_patterns": patterns.longest_patterns(row_patterns),
    }


def evolution_patterns(disc: DataFrame) -> DataFrame:
    """M9: per neighbourhood and decade the modal quality and price bin, as an
    ordered sequence; patterns of length >= 2 over the sequences."""
    labels = binning.bin_labels(5)
    idx = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(f"{TARGET}Bin"))
    dd = disc.select(
        "Neighborhood", features.decade(F.col("YearBuilt")).alias("decade"),
        F.struct(F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("OverallQual").cast("string")).alias("bin"),
                 F.col("OverallQual").cast("string").alias("text")).alias("q"), idx.alias("p"),
    ).where(F.col("decade").isNotNull() & F.col("p").isNotNull() & (F.col("p") > 0))
    mq = modes(dd, "q", ["Neighborhood", "decade"]).select("Neighborhood", "decade", F.col("mode.text").alias("q"))
    mp = modes(dd, "p", ["Neighborhood", "decade"]).select("Neighborhood", "decade", F.col("mode").alias("p"))
    steps = mp.join(mq, ["Neighborhood", "decade"], "left").select(
        "Neighborhood", "decade",
        F.concat(F.lit("Q:"), F.col("q"), F.lit("_P:"),
                 F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("p").cast("int"))).alias("item"),
    )
    keep = steps.groupBy("Neighborhood").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 2).select("Neighborhood")
    steps = steps.join(keep, "Neighborhood")
    p = patterns.sequential_patterns(steps, "Neighborhood", ["decade"], "item", EVOLUTION_RATIO)
    return patterns.patterns_as_text(p).where(F.col("length") >= 2)


# ---- phase 5 ---------------------------------------------------------------------------
def prepare_for_trees(df: DataFrame) -> tuple[DataFrame, list[str], list[str]]:
    """E1 ordinal maps (unmapped -> 0); remaining text and MSSubClass are categories."""
    out = features.ordinal_encode(df, {c: m for c, m in ORDINAL_MAPS.items() if c in df.columns}, unmapped=0)
    if "MSSubClass" in out.columns:
        out = out.withColumn("MSSubClass", F.col("MSSubClass").cast("string"))
    cats = text_columns(out)
    nums = numeric_columns(out, exclude=[KEY, TARGET])
    return out, nums, cats


@dataclass
class TrainResult:
    model: models.Boosted
    cv: DataFrame
    holdout_metrics: dict
    importances: DataFrame
    error_by_decile: DataFrame
    columns: list[str] = field(default_factory=list)


def train(df: DataFrame, folds: int = 10, **gbt) -> TrainResult:
    prepared, nums, cats = prepare_for_trees(df)
    cv = models.cross_validate(prepared, KEY, TARGET, nums, cats, folds=folds, **gbt)
    tr, va = models.holdout(prepared, KEY, 0.1)
    tr = tr.withColumn("_val", models.fold_of(KEY, 10, 7) == 0)
    tm = models.fit_trees(tr, KEY, TARGET, nums, cats, validation_col="_val", **gbt)
    pv = tm.predict(va, KEY).join(va.select(KEY, TARGET), KEY).withColumn("y", F.log1p(TARGET))
    metrics = models.regression_scores(pv, "y", "pred_log")
    metrics["mae_original"] = pv.agg(F.avg(F.abs(F.col(TARGET) - F.expm1("pred_log")))).first()[0]
    allp = tm.predict(prepared, KEY).join(prepared.select(KEY, TARGET), KEY).withColumn("y_log", F.log1p(TARGET))
    dec = binning.decile_labels(allp, TARGET, "decile")
    err = profile.error_by_segment(dec, "y_log", "pred_log", "decile")
    return TrainResult(tm, cv, metrics, tm.importances(df.sparkSession), err, nums + cats)


# ---- phase 6 ---------------------------------------------------------------------------
def score(result: TrainResult, test: DataFrame, tiers: binning.GroupTiers, out_path: str) -> DataFrame:
    """N9 with the training fit (tiers, categories, model); test imputation uses
    the test table's own statistics, as the reference does."""
    t = add_features(tiers.transform(clean_and_impute(test)))
    prepared, _, cats = prepare_for_trees(t)
    aligned = align_columns(prepared, [KEY, *result.columns], category_cols=cats)
    sub = result.model.predict(aligned, KEY).select(F.col(KEY), F.col("prediction").alias(TARGET))
    files.write_csv(sub, out_path)
    return files.read_csv(test.sparkSession, out_path, f"{KEY} bigint, {TARGET} double")


def discover(
    spark: SparkSession, train_path: str, test_path: str, out_path: str,
    forest: bool = True, folds: int = 10, gbt: dict | None = None,
) -> dict[str, DataFrame]:
    """The whole flow; returns every report as a DataFrame."""
    raw = read_table(spark, train_path)
    if raw.isEmpty():
        raise FileNotFoundError(train_path)
    kept = remove_outliers(raw, forest=forest)
    cleaned = clean_and_impute(kept)
    tiers = fit_tiers(cleaned)
    feat = measured(add_features(tiers.transform(cleaned)), "features")
    mi = mutual_info_scores(feat)
    nums, cats = distribution_columns(feat, mi)
    out = {
        "target_describe": profile.describe(kept, [TARGET]),
        "features": feat,
        "mutual_info": mi,
        "correlations": correlation_report(feat),
        "distributions": profile.distribution_report(feat, nums) if nums else None,
        "distribution_bins": profile.distribution_bins(feat, nums) if nums else None,
        "category_counts": profile.distribution_categories(feat, cats) if cats else None,
        "relations": dependence.relation_report(feat, TARGET, [c for c in nums if c != TARGET], cats),
    }
    out.update(mining_tables(feat, mi))
    res = train(feat, folds=folds, **(gbt or {}))
    out.update({"cv": res.cv, "importances": res.importances, "error_by_decile": res.error_by_decile})
    out["holdout"] = spark.createDataFrame([tuple(res.holdout_metrics.values())], list(res.holdout_metrics))
    test = read_table(spark, test_path, with_target=False)
    if not test.isEmpty():
        out["submission"] = score(res, test, tiers, out_path)
    return out


# ---- the notebook path: one-hot encoding and ridge ------------------------------------------
def encode_all(train: DataFrame, test: DataFrame) -> DataFrame:
    """Train (target dropped) and test concatenated with a split tag (S2/B14),
    imputed together, ordinal maps with unmapped kept null (notebook E1),
    MSSubClass as text, then one-hot with the first level dropped (E4)."""
    both = joins.concat_tagged({"train": train.drop(TARGET), "test": test}, tag_col="_split")
    both = clean_and_impute(both)
    both = features.ordinal_encode(both, {c: m for c, m in ORDINAL_MAPS.items() if c in both.columns}, unmapped=None)
    if "MSSubClass" in both.columns:
        both = both.withColumn("MSSubClass", F.col("MSSubClass").cast("string"))
    cats = [c for c in text_columns(both) if c != "_split"]
    return features.one_hot_drop_first(both, cats)


def notebook_ridge(train: DataFrame, test: DataFrame, alpha: float = 1.0, top_n: int = 20) -> dict[str, DataFrame]:
    """Correlation of every encoded feature with log1p(target) (top and bottom
    ``top_n``, K2) and a ridge fit on standardized features (N10)."""
    enc = encode_all(train, test)
    tr = joins.split_tagged(enc, "train", tag_col="_split").join(train.select(KEY, TARGET), KEY)
    tr = tr.withColumn("_y", F.log1p(TARGET))
    feats = [c for c in tr.columns if c not in (KEY, TARGET, "_y")]
    row = tr.agg(*[safe_corr(F.col(f"`{c}`"), F.col("_y")).alias(f"r{i}") for i, c in enumerate(feats)]).first()
    corr = tr.sparkSession.createDataFrame(
        [(c, None if row[f"r{i}"] is None else float(row[f"r{i}"])) for i, c in enumerate(feats)],
        "feature string, r double",
    ).where(F.col("r").isNotNull())
    return {
        "encoded": enc,
        "correlations": profile.top_and_bottom(corr, "r", top_n, tie=["feature"]),
        "ridge": models.ridge_fit(tr, "_y", feats, alpha=alpha),
        "test": joins.split_tagged(enc, "test", tag_col="_split"),
    }


__all__: Sequence[str] = [
    "add_features", "clean_and_impute", "discover", "fit_tiers", "house_schema", "mining_tables",
    "mutual_info_scores", "notebook_ridge", "prepare_for_trees", "read_table", "remove_outliers", "score", "train",
]
