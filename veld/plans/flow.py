"""End-to-end flows: preparation (stage A), training (stage B), scoring (stage C).

Each preparation stage is a lazy plan; the few ``fit`` steps (sparse columns, whole-number
columns, fill values, encodings, clip bounds) run one aggregation each.  Stage outputs
are written to the shared checkpoint folder (``materialize``), as the original handed
files from script to script: it cuts lineage and survives executor loss.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veld.functions import text as tx
from veld.operators import clean, encode, geo, select
from veld.plans import evaluate as ev
from veld.plans.models import weights_frame
from veld.session import materialize
from veld.sources.io import save_model

# Fixed values of the reference preparation chain.
BOOLEAN_FLAGS = ["Swimming_Pool", "hasTerrace", "hasGarden", "Furnished"]
CAPITALIZED = ["Subtype", "Kitchen_type", "State_of_building"]
TITLED = ["locality_name", "street"]
ADDRESS_KEY = ["street", "number", "Postal_code", "latitude", "longitude"]
LOCATION_PARTS = ["street", "number", "longitude", "latitude"]
STRING_COLUMNS = ["locality_name", "Postal_code", "street", "number"]
SUBTYPE_GROUPS = {
    "House": ["House", "Town house", "Country cottage"],
    "Luxury": ["Mansion", "Castle", "Manor house", "Villa"],
    "Commercial": ["Mixed use building", "Apartment block"],
    "Other": ["Bungalow", "Farmhouse", "Chalet", "Exceptional property", "Other property"],
}
STATE_RECODE = {"To restore": "To renovate", "To be done up": "To renovate", "Just renovated": "Good"}
EPC_RECODE = {"A+": "A", "A++": "A", "G": "F"}
CLIP_BOUNDS = {"Price": (0.05, 0.95), "Living_area": (0.10, 0.90),
               "gardenSurface": (0.10, 0.90), "landSurface": (0.10, 0.90),
               "Number_of_bedrooms": (0.01, 0.99)}
PROFILE_EXCLUDE = ["street", "number", "locality_name", "Postal_code"]


@dataclass
class Prepared:
    data: DataFrame
    fitted: dict = field(default_factory=dict)


def stage_clean(df: DataFrame, order: str) -> DataFrame:
    """Stage 1: row rules, flags, duplicates, text, postcode, sparse columns, types.

    ``order`` is the row's place in the source: of duplicates the first row stays.  The column
    goes afterwards."""
    df = clean.drop_columns(df, "Type_of_sale")
    df = clean.drop_rows_where(df, true_col="Starting_price", not_na_col="sale_annuity",
                               na_col="Price")
    df = clean.null_to_false(df, BOOLEAN_FLAGS)
    df = clean.fill_constant(df, {"gardenSurface": 0.0})
    df = clean.dedup_first(df, ["id"], [order])
    present = [c for c in ADDRESS_KEY if c in df.columns]
    df = clean.dedup_first(df, present, [order]).drop(order)
    df = df.withColumns({c: tx.capitalize(c) for c in CAPITALIZED if c in df.columns})
    df = df.withColumns({c: tx.title_case(c) for c in TITLED if c in df.columns})
    if "locality_name" in df.columns:
        df = df.withColumn("locality_name", tx.strip_code("locality_name"))
    df = clean.length_filter(df, "Postal_code", 4)
    df = clean.drop_all_missing(df, [c for c in LOCATION_PARTS if c in df.columns])
    # the row-level plan (two dedup shuffles) runs once; the column fits that follow
    # (sparse columns, whole-number columns) scan the written rows
    df = materialize(clean.nan_text_to_null(df), "stage1-rows")
    df = df.drop(*clean.sparse_columns(df, 0.3))
    return clean.convert_types(df, string_columns=STRING_COLUMNS)


def stage_geo(df: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """Stage 2: province, coordinate fallback lookup, city proximity flags."""
    df = geo.add_province(df)
    if lookup is not None:
        df = geo.fallback_lookup(df, lookup).drop("_missing", "_found")
    return geo.assign_cities(df)


def stage_subtype(df: DataFrame, keep: str = "House") -> DataFrame:
    """Stage 3: regroup subtypes, keep one group, drop the column."""
    if "Subtype" not in df.columns:
        return df
    df = df.withColumn("Subtype", encode.combine_categories("Subtype", SUBTYPE_GROUPS))
    return clean.equality_filter(df, "Subtype", keep).drop("Subtype")


def stage_categories(df: DataFrame, target: str = "Price", train_flag: str | None = None
                     ) -> tuple[DataFrame, encode.TargetEncoder]:
    """Stage 4: sparse columns, recodes, mode fill, target encoding (fit on train rows)."""
    df = clean.drop_sparse_columns(df, 0.3)
    recodes = {"State_of_building": STATE_RECODE, "epc": EPC_RECODE}
    df = df.withColumns({c: encode.recode(c, m) for c, m in recodes.items() if c in df.columns})
    cats = [c for c in recodes if c in df.columns]
    fit_rows = df.where(~F.col(train_flag)) if train_flag else df
    df = encode.apply_fill(df, encode.fill_values(fit_rows, cats, "mode"))
    fit_rows = df.where(~F.col(train_flag)) if train_flag else df
    enc = encode.TargetEncoder(cats, target).fit(fit_rows)
    return enc.transform(df), enc


def stage_numeric(df: DataFrame, train_flag: str | None = None
                  ) -> tuple[DataFrame, encode.QuantileClip]:
    """Stage 5: fills, quantile clipping (bounds from train rows), coordinate bounds."""
    fit_rows = df.where(~F.col(train_flag)) if train_flag else df
    df = encode.apply_fill(df, encode.fill_values(fit_rows, ["Number_of_facades"], "mode"))
    df = encode.apply_fill(df, encode.fill_values(fit_rows, ["landSurface", "Living_area"], "median"))
    clip = encode.QuantileClip({c: p for c, p in CLIP_BOUNDS.items() if c in df.columns})
    clip.fit(df.where(~F.col(train_flag)) if train_flag else df)
    df = clip.transform(df)
    if {"latitude", "longitude"} <= set(df.columns):
        df = clean.coordinate_bounds(df)
    return df, clip


def prepare_listings(raw: DataFrame, lookup: DataFrame | None = None, order: str = "position",
                     split_keys: Sequence[str] = ("id",), test_size: float = 0.2,
                     seed: int = 42) -> Prepared:
    """Stage A end to end.  ``is_test`` is assigned before any statistic is fitted, so
    encodings, fills and clip bounds come from training rows only."""
    s1 = stage_clean(raw, order)                 # written inside, before its column fits
    s2 = materialize(stage_geo(s1, lookup), "stage2")
    s3 = stage_subtype(s2).withColumn("is_test", select.split_flag(list(split_keys), test_size, seed))
    s4, enc = stage_categories(s3, "Price", "is_test")
    s4 = materialize(s4, "stage4")
    s5, clip = stage_numeric(s4, "is_test")
    return Prepared(materialize(s5, "stage5"), {"target_encoder": enc, "clip": clip})


# ---------------------------------------------------------------- stage B

# Fixed values of the reference searches.  ``max_depth`` None stands for its 40 too (Spark's
# trees end at 30 levels); ``min_samples_split``, ``solver`` and ``selection`` have no counterpart.
MODEL_SPACES = {
    "linear": {"fit_intercept": [True, False]},
    "ridge": {"alpha": [round(0.0001 + i * (1 - 0.0001) / 9, 6) for i in range(10)]},
    "lasso": {"alpha": [0.001, 0.01, 0.1, 1.0, 10.0, 100.0, 1000.0], "fit_intercept": [True, False]},
    "random_forest": {"n_estimators": [50, 100, 200, 500], "max_depth": [None, 10, 20, 30], "min_samples_leaf": [1, 2, 4],
                      "max_features": ["sqrt", "log2"], "bootstrap": [True, False]},
    "gbt": {"n_estimators": [50, 100], "max_depth": [3, 5], "learning_rate": [0.1, 0.2],
            "subsample": [0.5, 0.75], "colsample_bytree": [0.5, 0.75]},
}
ELASTIC_NET_SPACE = {"alpha": ("uniform", 0.01, 10.01), "l1_ratio": ("uniform", 0.0, 1.0)}
#: Parameters of each model where none are searched.
MODEL_DEFAULTS = {"linear": {}, "ridge": {"alpha": 1.0}, "lasso": {"alpha": 1.0},
                  "random_forest": {"n_estimators": 100, "max_depth": None, "max_features": "all"},
                  "gbt": {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.3}}
LEAKS = ("price_per_sqm", "price_per_sqm_land")


def model_report(train: DataFrame, test: DataFrame, features: Sequence[str], target: str,
                 kinds: Sequence[str] | None = None, fold: str = "fold", seed: int = 42
                 ) -> tuple[DataFrame, DataFrame]:
    """Every model with its default parameters: ``(model, phase, metric, value)`` on train and
    test rows, and ``(model, fold, r2)`` of the cross-validation on train rows (V3, V8)."""
    report = folds = None
    for kind in kinds or MODEL_DEFAULTS:
        _, metrics, cvs = ev.train_evaluate(train, test, kind, features, target, fold, seed, **MODEL_DEFAULTS[kind])
        metrics = ev.metrics_report(metrics)
        report = metrics if report is None else report.unionByName(metrics)
        folds = cvs if folds is None else folds.unionByName(cvs)
    return report, folds


def train_models(data: DataFrame, target: str = "Price", threshold: float = 0.2,
                 exclude: Sequence[str] = ("Postal_code", "id", *LEAKS), kinds: Sequence[str] | None = None,
                 n_iter: int | Mapping[str, int] = 10, folds: int = 6, seed: int = 42,
                 spaces: dict | None = None, test: DataFrame | None = None, save_path: str | None = None) -> dict:
    """Stage B: correlation select -> folds -> random search per model -> best (first wins
    ties) -> refit on all rows -> weights -> saved model.

    ``n_iter`` draws of each model's space, or a number for each kind.
    Returns the model, features, the results table and ``weights``; with ``test`` rows also
    ``report`` and ``cv`` of the models with default parameters (before the search) and
    ``residuals``, a seeded sample of one test row.  ``save_path`` is where the model goes."""
    spaces = spaces or MODEL_SPACES
    kinds = list(kinds or spaces)
    feats = [c for c in select.correlated_columns(data, target, threshold, list(exclude))
             if c != target]
    if not feats:
        raise ValueError("no feature passes the correlation threshold")
    key = [c for c in ("id",) if c in data.columns] or feats
    df = data.select(*key, *feats, target).withColumn("fold", select.fold_column(key, folds, seed))
    df = materialize(df, "train-set")
    out = {"features": feats}
    if test is not None:
        out["report"], out["cv"] = model_report(df, test, feats, target, kinds, "fold", seed)
    results = None
    for pos, kind in enumerate(kinds):
        cands = ev.sample_params(spaces[kind], n_iter if isinstance(n_iter, int) else n_iter[kind], seed)
        res = ev.random_search(df, kind, feats, target, cands).withColumn("kind_pos", F.lit(pos))
        results = res if results is None else results.unionByName(res)
    best = ev.best_of(results, "mean_r2", ["kind_pos", "candidate"]).first()
    model = ev.refit_best(data.sparkSession, df, best, feats, target, seed)
    out["weights"] = weights_frame(data.sparkSession, model, feats)
    if test is not None:
        out["residuals"] = ev.sample_residuals(model.transform(test), key, 1, seed, target)
    if save_path is not None:
        save_model(model, save_path)
    return out | {"model": model, "best": best, "results": results}


def score(model, df: DataFrame) -> DataFrame:
    """Stage C: batch scoring with a fitted (or loaded) ``PipelineModel``."""
    return model.transform(df)


__all__ = ["prepare_listings", "train_models", "model_report", "score", "stage_clean", "stage_geo",
           "stage_subtype", "stage_categories", "stage_numeric"]
