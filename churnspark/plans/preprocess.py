"""Composed preprocessing (C1-C5): fit once on train, apply to test and scenario tables.

* C1 client branch: parse dates -> drop missing rows -> contract date features.
* C2 price branch: drop missing rows -> series features (one aggregation).
* C3 merge: inner join of both on the key.
* C4 ``preprocess_estimator``: a ``pyspark.ml.Pipeline`` of fitted stages:
  low-information pruning -> outlier capping -> skew reduction -> scaling
  and one-hot encoding.  Keys and labels are passed through untouched.
* C5 ``full_estimator``: C4 + feature assembly + a classifier.
"""
from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.functions.dates import ContractDateFeatures, DateParser
from churnspark.operators.encode import ScaleEncode
from churnspark.operators.models import FeatureAssembler
from churnspark.operators.outliers import ReplaceOutliers
from churnspark.operators.prune import DropMissing, LowInformationPruner
from churnspark.operators.series import series_features
from churnspark.operators.skew import ReduceSkew


def client_branch(client: DataFrame, date_columns: list[str], reference_date: str = "2020-01-01", **names) -> DataFrame:
    parsed = DateParser(dateColumns=date_columns).transform(client)
    kept = DropMissing(axis=0).transform(parsed)
    return ContractDateFeatures(dateColumns=date_columns, referenceDate=reference_date, **names).transform(kept)


def price_branch(prices: DataFrame, price_columns: list[str], id_column: str = "id", date_column: str = "price_date",
                 tiebreak: list[str] | None = None, families=None, differences=None) -> DataFrame:
    kept = DropMissing(axis=0).transform(prices)
    return series_features(kept, price_columns, id_column=id_column, date_column=date_column, tiebreak=tiebreak,
                           families=families, differences=differences)


def merge_inputs(client: DataFrame, prices: DataFrame, id_column: str, date_columns: list[str],
                 price_columns: list[str], date_column: str = "price_date", tiebreak=None,
                 reference_date: str = "2020-01-01", families=None, differences=None) -> DataFrame:
    """The two branches joined on the key (inner, as the reference)."""
    c = client_branch(client, date_columns, reference_date)
    p = price_branch(prices, price_columns, id_column, date_column, tiebreak, families, differences)
    return c.join(p, id_column, "inner")


def discount_prices(prices: DataFrame, price_columns: list[str], discount: float = 0.15) -> DataFrame:
    """Every price multiplied by ``1 - discount``."""
    return prices.withColumns({c: F.col(c) * F.lit(1.0 - discount) for c in price_columns})


def preprocess_estimator(passthrough: list[str]) -> Pipeline:
    """C4."""
    return Pipeline(stages=[LowInformationPruner(exclude=passthrough), ReplaceOutliers(exclude=passthrough),
                            ReduceSkew(exclude=passthrough), ScaleEncode(exclude=passthrough)])


def full_estimator(passthrough: list[str], model) -> Pipeline:
    """Preprocessing, assembly of every remaining numeric column, classifier."""
    pre = preprocess_estimator(passthrough).getStages()
    return Pipeline(stages=[*pre, FeatureAssembler(exclude=passthrough), model])
