"""Date operators: multi-layout parsing, contract date features, date parts and
differences to a reference date (D1-D7).  All built-in expressions; no UDF."""
from __future__ import annotations

import datetime as _dt
import logging

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.functions.exprs import python_to_spark_date_format, try_parse_date

log = logging.getLogger(__name__)

# The strftime layouts accepted for a reference date, in order.
REFERENCE_DATE_FORMATS = ["%Y-%m-%d", "%d-%m-%Y", "%m/%d/%Y", "%d %b %Y", "%B %d, %Y"]


def parse_and_format(c, standard_format: str = "%Y-%m-%d", return_type: str = "string") -> Column:
    """First accepted layout wins; unparseable -> NULL.  ``return_type``
    ``"datetime"`` gives a timestamp, anything else a string in ``standard_format``."""
    d = try_parse_date(c)
    if return_type == "datetime":
        return d.cast("timestamp")
    if return_type != "string":
        log.warning("return_type %r is unknown: dates come back as text", return_type)
    return F.date_format(d, python_to_spark_date_format(standard_format))


def coerce_timestamp(df: DataFrame, c: str) -> Column:
    """Coercing cast to a timestamp; invalid -> NULL."""
    dt = dict((f.name, f.dataType) for f in df.schema.fields)[c]
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.col(c).cast("timestamp_ntz")
    if isinstance(dt, T.DateType):
        return F.col(c).cast("timestamp_ntz")
    s = F.col(c).cast("string")
    dashed = F.regexp_replace(s, r"^(\s*\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3")
    iso = F.when(dashed.rlike(r"^\s*\d{4}-\d"), dashed.try_cast("timestamp"))  # a time alone would get today's date
    slashed = F.try_to_timestamp(F.trim(s), F.lit("M/d/yyyy H:mm[:ss]"))
    parsed = F.coalesce(F.try_to_timestamp(s, F.lit("yyyy-MM-dd HH:mm:ss")), try_parse_date(s).cast("timestamp"), iso, slashed)
    return parsed.cast("timestamp_ntz")


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days of ``later - earlier``, floored like a timedelta's ``.days``."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return F.floor(micros / F.lit(86_400_000_000)).cast("bigint")


def resolve_reference_date(reference_date: str | None) -> _dt.datetime:
    """Literal in one of the accepted layouts, else today (with a warning)."""
    if reference_date is None:
        return _dt.datetime.combine(_dt.date.today(), _dt.time())
    for fmt in REFERENCE_DATE_FORMATS:
        try:
            return _dt.datetime.strptime(reference_date, fmt)
        except ValueError:
            continue
    log.warning("reference date %r has none of the accepted layouts: today is taken", reference_date)
    return _dt.datetime.combine(_dt.date.today(), _dt.time())


class DateParser(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """D1 as a pipeline stage: reformat the date columns in place."""

    dateColumns = Param(Params._dummy(), "dateColumns", "date columns", TypeConverters.toListString)
    standardFormat = Param(Params._dummy(), "standardFormat", "strftime layout of the output", TypeConverters.toString)

    @keyword_only
    def __init__(self, dateColumns=None, standardFormat="%Y-%m-%d"):
        super().__init__()
        self._setDefault(dateColumns=[], standardFormat="%Y-%m-%d")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        fmt = self.getOrDefault(self.standardFormat)
        cols = [c for c in self.getOrDefault(self.dateColumns) if c in df.columns]
        return df.withColumns({c: parse_and_format(F.col(c), fmt) for c in cols})


def contract_date_features(df: DataFrame, date_columns: list[str], reference_date: str = "2020-01-01",
                           start: str = "date_activ", end: str = "date_end", renewal: str = "date_renewal",
                           modification: str = "date_modif_prod", drop_original: bool = True) -> DataFrame:
    """D3: contract length and days until end / renewal / since modification."""
    ref = F.lit(_dt.datetime.strptime(reference_date, "%Y-%m-%d")).cast("timestamp_ntz")
    ts = {c: coerce_timestamp(df, c) for c in (start, end, renewal, modification)}
    out = df.withColumns({
        "contract_length": days_between(ts[end], ts[start]),
        "days_until_end": days_between(ref, ts[end]),
        "days_until_renewal": days_between(ref, ts[renewal]),
        "days_since_modification": days_between(ref, ts[modification]),
    })
    return out.drop(*date_columns) if drop_original else out


class ContractDateFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """D3 as a pipeline stage."""

    dateColumns = Param(Params._dummy(), "dateColumns", "date columns", TypeConverters.toListString)
    referenceDate = Param(Params._dummy(), "referenceDate", "ISO reference date", TypeConverters.toString)
    startCol = Param(Params._dummy(), "startCol", "", TypeConverters.toString)
    endCol = Param(Params._dummy(), "endCol", "", TypeConverters.toString)
    renewalCol = Param(Params._dummy(), "renewalCol", "", TypeConverters.toString)
    modificationCol = Param(Params._dummy(), "modificationCol", "", TypeConverters.toString)
    dropOriginal = Param(Params._dummy(), "dropOriginal", "", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, dateColumns=None, referenceDate="2020-01-01", startCol="date_activ", endCol="date_end",
                 renewalCol="date_renewal", modificationCol="date_modif_prod", dropOriginal=True):
        super().__init__()
        self._setDefault(dateColumns=[], referenceDate="2020-01-01", startCol="date_activ", endCol="date_end",
                         renewalCol="date_renewal", modificationCol="date_modif_prod", dropOriginal=True)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        g = self.getOrDefault
        return contract_date_features(df, g(self.dateColumns), g(self.referenceDate), g(self.startCol),
                                      g(self.endCol), g(self.renewalCol), g(self.modificationCol),
                                      g(self.dropOriginal))


def date_columns(df: DataFrame, features: list[str], calculate_difference: bool = True,
                 reference_date: str | None = None) -> DataFrame:
    """Replace each date column by its parsed timestamp and add year, month,
    day, full weekday name and (optionally) the difference to the reference
    date as an interval and in whole days.  Missing columns and columns with
    no valid date are skipped (one counting pass for all of them)."""
    present = [f for f in features if f in df.columns]
    for f in features:
        if f not in df.columns:
            log.warning("no column %s: skipped", f)
    if not present:
        return df
    parsed = {f: coerce_timestamp(df, f) for f in present}
    counts = df.agg(*[F.count(parsed[f]).alias(f"n{i}") for i, f in enumerate(present)]).first()
    valid = [f for i, f in enumerate(present) if counts[f"n{i}"] > 0]
    out = df.withColumns({f: parsed[f] for f in valid})
    new = {}
    ref = F.lit(resolve_reference_date(reference_date)).cast("timestamp_ntz") if calculate_difference else None
    for f in valid:
        c = F.col(f)
        new[f"{f}_year"] = F.year(c)
        new[f"{f}_month"] = F.month(c)
        new[f"{f}_day"] = F.dayofmonth(c)
        new[f"{f}_weekday"] = F.date_format(c, "EEEE")
        if calculate_difference:
            new[f"actual_date - {f}"] = ref - c
            new[f"actual_date - {f} in days"] = days_between(ref, c)
    return out.withColumns(new)
