"""A stored gram model as an ML stage."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from glotspark import columns as C

from .gram_model import load_gram_model, predict


class GramClassifier(
    Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Adds the best class of the gram model stored at ``modelPath``: ``string -> string``.

    With ``outputCol="label"`` and a guesser model it is the language guesser. A registry stores
    the gram model with the stage, see ``glotspark.sources.registry``.
    """

    modelPath = Param(Params._dummy(), "modelPath", "stored gram model", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, modelPath=None):
        super().__init__()
        self._setDefault(inputCol=C.FILTERED, outputCol=C.PREDICTION)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def setModelPath(self, value: str) -> GramClassifier:
        return self._set(modelPath=value)

    def getModelPath(self) -> str:
        return self.getOrDefault(self.modelPath)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        model = load_gram_model(dataset.sparkSession, self.getModelPath())
        return predict(dataset, self.getInputCol(), self.getOutputCol(), model)
