"""A pipeline stage that gives levels of text columns their codes from a written dictionary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLWritable
from pyspark.sql import DataFrame, SparkSession

from lapframe.operators.levels import level_dictionary, with_codes


class LevelEncoder(Estimator):
    """Learns the levels of text columns. The model adds ``{column}_code``."""

    def __init__(self, columns: Sequence[str]):
        super().__init__()
        self.columns = list(columns)

    def _fit(self, dataset: DataFrame) -> LevelEncoderModel:
        return LevelEncoderModel.of(self.columns, level_dictionary(dataset, self.columns))


class LevelEncoderModel(Model, MLReadable, MLWritable):
    columns = Param(Params._dummy(), "columns", "text columns", TypeConverters.toListString)
    dictionary: DataFrame

    @classmethod
    def of(cls, columns: Sequence[str], dictionary: DataFrame) -> LevelEncoderModel:
        model = cls()
        model._set(columns=list(columns))
        model.dictionary = dictionary
        return model

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return with_codes(dataset, self.getOrDefault(self.columns), self.dictionary)

    def write(self) -> DefaultParamsWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> DefaultParamsReader:
        return _Reader(cls)


class _Writer(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.dictionary.write.mode("overwrite").parquet(f"{path}/dictionary")


class _Reader(DefaultParamsReader):
    def load(self, path: str) -> LevelEncoderModel:
        model = super().load(path)
        model.dictionary = SparkSession.active().read.parquet(f"{path}/dictionary")
        return model
