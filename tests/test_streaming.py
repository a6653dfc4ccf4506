from pyspark.sql import functions as F

from churnspark.plans import domain as dm
from churnspark.plans import scenario as S
from churnspark.streaming import micro_batch_scorer


def test_stream_scores_equal_batch_scores(spark, sf001, tmp_path):
    fitted = S.fit_churn_model(spark, sf001, n_estimators=3)
    src = str(tmp_path / "clients")
    fitted.client.write.parquet(src)
    stream = spark.readStream.schema(fitted.client.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = str(tmp_path / "scores")
    q = (stream.writeStream.foreachBatch(micro_batch_scorer(fitted.model, fitted.prices, fitted.labels, out))
               .option("checkpointLocation", str(tmp_path / "chk")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    batch = S.merged_with_labels(fitted.client, fitted.prices, fitted.labels)
    from churnspark.operators.models import predict
    exp = predict(fitted.model, batch).select(dm.ID, F.col("score").alias("e"))
    j = got.join(exp, dm.ID)
    assert got.count() == exp.count() == j.count()
    assert j.agg(F.max(F.abs(F.col("prob_churned") - F.col("e")))).first()[0] < 1e-12
