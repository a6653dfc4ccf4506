"""What-if price discount (L15) and batch inference (C6) on the churn domain.

Train: stratified 80/20 split of clients (M1; prices follow their client,
M2), class weights balanced x positive weight 9 (L3), full pipeline
(C4 + boosted trees) fitted on the training clients.  Scenario: prices x
(1 - discount) (P9) go through the same fitted pipeline; base and
discounted probabilities are joined per client (J5).
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.operators.metrics import confusion_metrics
from churnspark.operators.models import boosted_trees, class_weights, predict, right_size, with_weights
from churnspark.operators.sampling import aligned_split, class_counts, split_labels
from churnspark.plans import domain as dm
from churnspark.plans.preprocess import discount_prices, full_estimator, merge_inputs
from churnspark.session import cut_lineage, scratch_table

LABEL = "churn"


@dataclass
class Fitted:
    model: object
    train: DataFrame
    validation_ids: DataFrame
    client: DataFrame
    prices: DataFrame
    labels: DataFrame


def merged_with_labels(client, prices, labels, price_columns: list[str] | None = None) -> DataFrame:
    m = merge_inputs(client, prices, dm.ID, dm.DATE_COLUMNS, price_columns or dm.PRICE_COLUMNS, date_column="price_date",
                     tiebreak=["price_seq"])
    return m.join(labels, dm.ID, "inner")


def fit_churn_model(spark: SparkSession, sf_dir: str, seed: int = 42, n_estimators: int = 100,
                    positive_weight: float = 9.0, test_size: float = 0.2) -> Fitted:
    client, prices, labels = dm.client_table(spark, sf_dir), dm.price_table(spark, sf_dir), dm.churn_labels(spark, sf_dir)
    tagged = split_labels(labels, LABEL, dm.ID, test_size=test_size, seed=seed)
    train_ids = tagged.where(F.col("split") == "train").select(dm.ID)
    val_ids = tagged.where(F.col("split") == "test").select(dm.ID)
    train = merged_with_labels(aligned_split(client, train_ids, dm.ID), aligned_split(prices, train_ids, dm.ID), labels)
    train = cut_lineage(train)  # entity-level table, read by every fitting job below
    counts = class_counts(train, LABEL)
    weights = class_weights(train, LABEL, positive_weight=positive_weight)
    train = cut_lineage(right_size(with_weights(train, LABEL, weights), sum(counts.values())))
    est = full_estimator([dm.ID, LABEL, "weight"], boosted_trees(LABEL, n_estimators=n_estimators, seed=seed))
    return Fitted(est.fit(train), train, val_ids, client, prices, labels)


def score(fitted: Fitted, client: DataFrame, prices: DataFrame) -> DataFrame:
    """Probabilities for the validation clients of the given client/price tables."""
    ids = fitted.validation_ids
    m = merged_with_labels(aligned_split(client, ids, dm.ID), aligned_split(prices, ids, dm.ID), fitted.labels)
    return predict(fitted.model, m).select(dm.ID, LABEL, F.col("score").alias("prob_churned"), "prediction")


def scenario_comparison(fitted: Fitted, discount: float = 0.15) -> DataFrame:
    """Per validation client: churn, base and discounted probability of churn.

    The discounted prices go through the series features as further columns
    of the same aggregation, so clients and prices are read once for both scores."""
    scenario = {c: f"{c}_scenario" for c in dm.PRICE_COLUMNS}
    ids = fitted.validation_ids
    both = fitted.prices.withColumns({s: F.col(c) for c, s in scenario.items()})
    both = discount_prices(both, list(scenario.values()), discount)
    m = scratch_table(merged_with_labels(aligned_split(fitted.client, ids, dm.ID), aligned_split(both, ids, dm.ID), fitted.labels,
                                         [*dm.PRICE_COLUMNS, *scenario.values()]), "scenario-rows")
    base_columns = [c for c in m.columns if not any(s in c for s in scenario.values())]

    def of_scenario(name: str) -> str:
        for c, s in scenario.items():
            if name.replace(c, s) in m.columns and c in name:
                return name.replace(c, s)
        return name

    def scored(columns):
        return predict(fitted.model, m.select(*columns)).select(dm.ID, LABEL, F.col("score").alias("prob_churned"), "prediction")
    return compare_scores(scored(base_columns), scored([F.col(of_scenario(c)).alias(c) for c in base_columns]))


def compare_scores(base: DataFrame, disc: DataFrame) -> DataFrame:
    """Base and scenario probabilities side by side, full outer on the client."""
    return (base.select(dm.ID, LABEL, "prob_churned")
                .join(disc.select(dm.ID, F.col(LABEL).alias("__l"), F.col("prob_churned").alias("prob_churned_discount")),
                      dm.ID, "full")
                .select(dm.ID, F.coalesce(LABEL, "__l").alias(LABEL), "prob_churned", "prob_churned_discount"))


def scenario_effect(spark: SparkSession, sf_dir: str, discount: float = 0.15, **kw) -> DataFrame:
    """L15 per client: churned validation clients still predicted to churn without discount,
    with both probabilities."""
    cmp = scenario_comparison(fit_churn_model(spark, sf_dir, **kw), discount)
    return cmp.where((F.col(LABEL) == 1) & (F.col("prob_churned") > 0.5))


def scenario_summary(cmp: DataFrame) -> DataFrame:
    """L15 counts: churned clients, correctly predicted without / with discount, and the share."""
    c = cmp.where(F.col(LABEL) == 1)
    return c.agg(F.count(F.lit(1)).alias("n_churned"),
                 F.count_if(F.col("prob_churned") > 0.5).alias("n_predicted_no_discount"),
                 F.count_if(F.col("prob_churned_discount") > 0.5).alias("n_predicted_discount")).withColumn(
        "share_predicted_no_discount", F.col("n_predicted_no_discount") / F.col("n_churned") * 100)


def batch_inference(model, client: DataFrame, prices: DataFrame, labels: DataFrame) -> DataFrame:
    """Stored pipeline -> predictions -> accuracy / precision / recall (one lazy plan)."""
    m = merged_with_labels(client, prices, labels)
    return confusion_metrics(predict(model, m), LABEL, "prediction").select(
        F.col("accuracy").alias("test_accuracy"), F.col("precision").alias("test_precision"),
        F.col("recall").alias("test_recall"))
