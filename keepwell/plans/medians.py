"""Imputation by exact medians, as a stage of a pyspark.ml pipeline."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.operators.mlprep import fitted_medians


def _known(column: str) -> Column:
    """The value, NULL instead of NaN."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


class _Columns(HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    pass


class ExactMedianImputer(Estimator, _Columns):
    """Learns the exact median of every input column; a column without any value gets 0."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ExactMedianModel:
        columns = self.getInputCols()
        medians = fitted_medians(dataset.select([_known(c).alias(c) for c in columns]), columns)
        return ExactMedianModel.of(columns, self.getOutputCols(), medians)


class ExactMedianModel(Model, _Columns):
    """Fills NULL and NaN of each input column with its median, into the output column."""

    medians = Param(Params._dummy(), "medians", "the median of each input column", TypeConverters.toListFloat)

    @classmethod
    def of(cls, columns: Sequence[str], outputs: Sequence[str], medians: Mapping[str, float | None]) -> ExactMedianModel:
        found = [medians.get(c) for c in columns]
        return cls()._set(inputCols=list(columns), outputCols=list(outputs), medians=[0.0 if m is None else m for m in found])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        filled = zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.medians), strict=True)
        return dataset.withColumns(
            {out: F.coalesce(_known(c), F.lit(m)) for c, out, m in filled}
        )
