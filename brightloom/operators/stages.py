"""Pipeline stages of our own, with parameters and saved like the built-in ones."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from brightloom.functions.numeric import bin_by_bounds
from brightloom.operators.features import learn_codes
from brightloom.session import scratch_path

#: A code table of at most so many rows is broadcast.
BROADCAST_CODES = 200_000


class AgeClasses(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Replace a number by the name of its age class."""

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        classes = bin_by_bounds(F.col(self.getInputCol()))
        return dataset.withColumn(self.getOutputCol(), classes).drop(self.getInputCol())


class _IndicatorParams(HasInputCol, HasOutputCol):
    dropFirst = Param(Params._dummy(), "dropFirst", "leave out the first category", TypeConverters.toBoolean)
    codesPath = Param(
        Params._dummy(), "codesPath", "folder of the learned code table; must outlive the model", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(dropFirst=False, outputCol="indicators")


class Indicators(Estimator, _IndicatorParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the categories of a column as a table of codes, however many there are; nothing is collected."""

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None, dropFirst: bool | None = None, codesPath: str | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> IndicatorsModel:
        values = dataset.select(F.col(self.getInputCol()).cast("string").alias("c"))
        path = self.getOrDefault(self.codesPath) if self.isDefined(self.codesPath) else scratch_path(dataset.sparkSession, "codes")
        learn_codes(values, "c", by="value").write.mode("overwrite").parquet(path)
        model = IndicatorsModel()
        model._set(
            inputCol=self.getInputCol(), outputCol=self.getOutputCol(), codesPath=path, dropFirst=self.getOrDefault(self.dropFirst),
            size=dataset.sparkSession.read.parquet(path).count())
        return model


class IndicatorsModel(Model, _IndicatorParams, DefaultParamsReadable, DefaultParamsWritable):
    """Adds a sparse 0/1 vector with a place for each category, in their order; a null or a value not seen has zeros only."""

    size = Param(Params._dummy(), "size", "number of categories", TypeConverters.toInt)

    def codes(self, spark) -> DataFrame:
        return spark.read.schema("value string, code bigint").parquet(self.getOrDefault(self.codesPath))

    def categories(self, spark) -> list[str]:
        """The category of each place of the vector, for few categories: a caller that names a column for each."""
        rows = self.codes(spark).orderBy("code").collect()
        return [r["value"] for r in rows][int(self.getOrDefault(self.dropFirst)):]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark, column, out = dataset.sparkSession, self.getInputCol(), self.getOutputCol()
        first, size = int(self.getOrDefault(self.dropFirst)), self.getOrDefault(self.size)
        width = max(size - first, 0)
        if not width:
            return dataset.withColumn(out, array_to_vector(F.array().cast("array<double>")))
        codes = self.codes(spark).select(F.col("value").alias("_value"), (F.col("code") - first).alias("_code"))
        codes = F.broadcast(codes) if size <= BROADCAST_CODES else codes
        coded = dataset.join(codes, F.col(column).cast("string") == F.col("_value"), "left")
        coded = coded.withColumn("_code", F.when(F.col("_code") >= 0, F.col("_code")).otherwise(width).cast("double")).drop("_value")
        encoder = OneHotEncoder(inputCol="_code", outputCol=out, handleInvalid="keep").fit(
            spark.createDataFrame([(float(width - 1),)], "_code double"))
        return encoder.transform(coded).drop("_code")
