"""Sources and sinks.

* ``read_csv`` / ``read_parquet`` (S1, S2); ``load_table`` (S3): stored
  parquet first, else a CSV fallback, else ``FileNotFoundError``.
* ``write_csv`` (S4).
* ``log_dataset`` (S5): the frame as parquet under ``<root>/datasets/<name>``
  plus one appended manifest row: name, context, source, schema JSON,
  rows, elements and an order-free digest ``bit_xor(xxhash64(row))`` —
  all from one aggregate.
* ``save_pipeline`` / ``load_pipeline`` (S6): ``PipelineModel`` persistence;
  every custom stage is ``DefaultParamsWritable``.
* ``log_run`` (S7): long rows ``(run_name, kind, key, value, ts)`` appended to
  a parquet table.
* ``Signature`` (S8): a stage that holds a schema and refuses frames that
  differ; ``save_pipeline`` puts one before and one behind the model.
"""
from __future__ import annotations

import datetime as _dt
import json

from pyspark import keyword_only
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST_SCHEMA = ("name string, context string, source string, schema_json string, num_rows long, "
                   "num_elements long, digest long, logged_at timestamp")
RUN_SCHEMA = "run_name string, kind string, key string, value string, ts timestamp"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Header row; explicit schema when known (no inference pass), else inferred."""
    r = spark.read.option("header", True)
    return r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", True).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S2."""
    return spark.read.parquet(path)


def load_table(spark: SparkSession, primary: str, fallback: str | None = None,
               schema: T.StructType | str | None = None) -> DataFrame:
    """S3: the stored dataset, else the CSV fallback, else ``FileNotFoundError``."""
    try:
        return spark.read.parquet(primary)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # a broken dataset is an error, not a reason to read another
            raise
    if fallback is not None:
        try:
            df = read_csv(spark, fallback, schema)
            df.schema  # noqa: B018  (resolves the path now)
            return df
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"Could not find {primary} nor {fallback}")


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite, with a header row."""
    df.write.mode("overwrite").option("header", True).csv(path)


def digest_expr(df: DataFrame):
    """Order-free digest of the rows."""
    return F.bit_xor(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))


def log_dataset(df: DataFrame, root: str, name: str, source: str, context: str) -> DataFrame:
    """Store the frame and append its manifest row; returns the manifest row."""
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/datasets/{name}"
    df.write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    width = len(stored.columns)
    row = stored.agg(F.count(F.lit(1)).alias("num_rows"), digest_expr(stored).alias("digest"))
    manifest = row.select(F.lit(name).alias("name"), F.lit(context).alias("context"), F.lit(source).alias("source"),
                          F.lit(stored.schema.json()).alias("schema_json"), "num_rows",
                          (F.col("num_rows") * width).alias("num_elements"), "digest",
                          F.current_timestamp().alias("logged_at"))
    manifest.write.mode("append").parquet(f"{root.rstrip('/')}/manifest")
    return spark.read.parquet(f"{root.rstrip('/')}/manifest").where(F.col("name") == name)


def load_logged_dataset(spark: SparkSession, root: str, name: str, fallback: str | None = None,
                        schema=None) -> DataFrame:
    """S3 over the S5 layout."""
    return load_table(spark, f"{root.rstrip('/')}/datasets/{name}", fallback, schema)


class SignatureError(ValueError):
    """A frame that differs from the signature of a saved pipeline."""


def signature_faults(df: DataFrame, schema_json: str) -> list[str]:
    """What of ``df`` differs from the stored schema, in words: missing, retyped and extra columns."""
    expected = {f.name: f.dataType for f in T.StructType.fromJson(json.loads(schema_json)).fields}
    got = {f.name: f.dataType for f in df.schema.fields}
    faults = [f"missing: {c}" for c in expected if c not in got]
    faults += [f"retyped: {c} is {got[c].simpleString()}, not {t.simpleString()}" for c, t in expected.items() if c in got and got[c] != t]
    return faults + [f"extra: {c}" for c in got if c not in expected]


class Signature(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """S8 as a stage: passes frames of its schema through and refuses all others, before any job runs.

    ``allowed``: extra columns that may be there (labels, for instance)."""

    schemaJson = Param(Params._dummy(), "schemaJson", "the schema that frames must have", TypeConverters.toString)
    place = Param(Params._dummy(), "place", "named in errors: input or output", TypeConverters.toString)
    allowed = Param(Params._dummy(), "allowed", "extra columns that are let through", TypeConverters.toListString)

    @keyword_only
    def __init__(self, schemaJson=None, place="input", allowed=None):
        super().__init__()
        self._setDefault(schemaJson=T.StructType([]).json(), place="input", allowed=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df):
        allowed = set(self.getOrDefault(self.allowed))
        faults = [f for f in signature_faults(df, self.getOrDefault(self.schemaJson)) if f.removeprefix("extra: ") not in allowed]
        if faults:
            raise SignatureError(f"{self.getOrDefault(self.place)} differs from the pipeline's signature: {'; '.join(faults)}")
        return df


def signed_pipeline(model: PipelineModel, example: DataFrame, allowed: list[str] | None = None) -> PipelineModel:
    """``model`` between a check of its input (the schema of ``example``) and one of its output.  No data is read."""
    first = Signature(schemaJson=example.schema.json(), place="input", allowed=allowed or [])
    last = Signature(schemaJson=model.transform(example).schema.json(), place="output", allowed=allowed or [])
    return PipelineModel([first, *model.stages, last])


def save_pipeline(model: PipelineModel, path: str, example: DataFrame | None = None, allowed: list[str] | None = None) -> None:
    """S6; with an ``example`` frame the model is saved with its signature."""
    (signed_pipeline(model, example, allowed) if example is not None else model).write().overwrite().save(path)


def load_pipeline(path: str, like: DataFrame | None = None) -> PipelineModel:
    """S6; ``like``: a frame that the loaded model must accept, checked against its signature at once."""
    model = PipelineModel.load(path)
    if like is not None:
        for stage in model.stages:
            if isinstance(stage, Signature) and stage.getOrDefault(stage.place) == "input":
                stage.transform(like)
    return model


def log_run(spark: SparkSession, root: str, run_name: str, params: dict | None = None,
            metrics: dict | None = None) -> DataFrame:
    """Append params and metrics of a run as long rows."""
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    rows = [(run_name, "param", k, json.dumps(v), now) for k, v in (params or {}).items()]
    rows += [(run_name, "metric", k, json.dumps(v), now) for k, v in (metrics or {}).items()]
    spark.createDataFrame(rows, RUN_SCHEMA).write.mode("append").parquet(f"{root.rstrip('/')}/runs")
    return spark.read.parquet(f"{root.rstrip('/')}/runs").where(F.col("run_name") == run_name)


def check_signature(df: DataFrame, schema_json: str) -> bool:
    """The same field names and types as the stored signature, and no others."""
    return not signature_faults(df, schema_json)


def stored_digest_matches(spark: SparkSession, root: str, name: str) -> bool:
    """The stored dataset still has the digest of its latest manifest row."""
    rows = spark.read.parquet(f"{root.rstrip('/')}/manifest").where(F.col("name") == name)
    latest = rows.orderBy(F.desc("logged_at")).first()
    stored = load_logged_dataset(spark, root, name)
    return latest is not None and stored.agg(digest_expr(stored).alias("d")).first()["d"] == latest["digest"]
