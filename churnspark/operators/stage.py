"""Base classes for fitted stages whose state is a small JSON document.

Fitted state (thresholds, category lists, exponents) is one value per
column, decided on the driver from an aggregate; it is stored as a Param so
``DefaultParamsWritable`` persists it with the pipeline (S6)."""
from __future__ import annotations

import json

from pyspark.ml import Model
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable


class JsonStateModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    state = Param(Params._dummy(), "state", "fitted state as JSON", TypeConverters.toString)

    def __init__(self, state: dict | None = None):
        super().__init__()
        self._setDefault(state="{}")
        if state is not None:
            self._set(state=json.dumps(state))

    @property
    def fitted(self) -> dict:
        return json.loads(self.getOrDefault(self.state))
