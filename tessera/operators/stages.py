"""Pipeline stages on ``array<double>`` columns (MLlib ``Transformer`` /
``Estimator`` subclasses, so they chain with MLlib stages and copy with
their params)."""

from __future__ import annotations

import importlib

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions import vectors as V


def as_array_col(df: DataFrame, col: str):
    """The column as ``array<double>`` whether it holds arrays or ML vectors."""
    if isinstance(df.schema[col].dataType, VectorUDT):
        return vector_to_array(F.col(col))
    return F.col(col).cast("array<double>")


class _InOut(HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    pass


class ColumnTransform(Transformer, _InOut):
    """A double -> double function as a stage, given as a SQL expression in
    which ``{x}`` stands for the input column (stays JVM-side)."""

    expr = Param(Params._dummy(), "expr", "SQL expression with {x} for the input",
                 typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, expr=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df):
        x = f"`{self.getInputCol()}`"
        return df.withColumn(self.getOutputCol(), F.expr(self.getOrDefault(self.expr).format(x=x)))


class PandasColumnTransform(Transformer, HasInputCol, HasOutputCol):
    """Free Python code as a stage: a vectorised function over a pandas
    Series of doubles or of numpy arrays (Arrow batches, never per row).
    It holds code, so it has no reader or writer; see ``NamedColumnTransform``."""

    def __init__(self, fn, inputCol: str, outputCol: str, returnType: str = "double",
                 rowwise_arrays: bool = False):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)
        self.fn, self.returnType, self.rowwise_arrays = fn, returnType, rowwise_arrays

    def _transform(self, df):
        fn, rowwise = self.fn, self.rowwise_arrays

        @F.pandas_udf(self.returnType)
        def apply(s: pd.Series) -> pd.Series:
            if rowwise:
                # stack the batch into one matrix: one numpy call per batch
                if len(s) == 0:
                    return pd.Series([], dtype="float64")
                m = np.stack(s.to_numpy())
                return pd.Series(fn(m))
            return fn(s)

        return df.withColumn(self.getOutputCol(), apply(F.col(self.getInputCol())))


def column_function(returnType: str = "double", rowwise_arrays: bool = False):
    """Mark a module's function for ``NamedColumnTransform``: vectorised over a pandas
    Series of doubles, or (``rowwise_arrays``) over a batch's arrays as one matrix."""

    def mark(fn):
        fn.column_function = (returnType, rowwise_arrays)
        return fn

    return mark


class NamedColumnTransform(Transformer, _InOut):
    """Free Python code as a stage that can be saved: the stage keeps the function's
    name, ``module:function``, and finds it again when it runs.  Only functions marked
    with ``column_function`` are run, so a saved stage can't name any other code.  Their module
    must be importable on the workers too, as this package is."""

    function = Param(Params._dummy(), "function", "module:function of a marked function",
                     typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, function=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _found(self):
        name = self.getOrDefault(self.function)
        module, _, attr = name.partition(":")
        fn = getattr(importlib.import_module(module), attr, None) if attr else None
        if not hasattr(fn, "column_function"):
            raise ValueError(f"{name} is not a marked column function")
        return fn

    def _transform(self, df):
        fn = self._found()
        kind, rowwise = fn.column_function
        return PandasColumnTransform(fn, self.getInputCol(), self.getOutputCol(), kind, rowwise).transform(df)


class Array2Vector(Transformer, _InOut):
    """Array of number strings -> ``array<double>`` (or an ML vector);
    malformed numbers raise, as ``toDouble`` does."""

    asVector = Param(Params._dummy(), "asVector", "emit an ML vector",
                     typeConverter=TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, asVector=False):
        super().__init__()
        self._setDefault(asVector=False)
        self._set(**self._input_kwargs)

    def _transform(self, df):
        arr = T.parse_doubles(self.getInputCol())
        if self.getOrDefault(self.asVector):
            arr = array_to_vector(arr)
        return df.withColumn(self.getOutputCol(), arr)


class ArraySlicer(Transformer, _InOut):
    """Pick 0-based positions (``VectorSlicer.setIndices``) from an array or
    vector column; ``indices`` may be a list or ``(start, stop)`` range."""

    indices = Param(Params._dummy(), "indices", "0-based positions",
                    typeConverter=TypeConverters.toListInt)
    start = Param(Params._dummy(), "start", "first position of a range",
                  typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, indices=None, start=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df):
        arr = as_array_col(df, self.getInputCol())
        if self.isSet(self.indices):
            out = F.array(*[arr[int(i)] for i in self.getOrDefault(self.indices)])
        else:  # open range start..end: the width comes from each row
            s = self.getOrDefault(self.start)
            out = F.slice(arr, s + 1, F.size(arr) - s)
        return df.withColumn(self.getOutputCol(), out)


class FirstElement(Transformer, _InOut):
    """Vector -> its first element as a double (native, no UDF)."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df):
        return df.withColumn(self.getOutputCol(), as_array_col(df, self.getInputCol())[0])


class PolyExpand2(Transformer, _InOut):
    """Degree-2 polynomial expansion on arrays, MLlib's order (native)."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df):
        return df.withColumn(self.getOutputCol(), V.poly_expand_2(as_array_col(df, self.getInputCol())))


class LabelShift(Estimator, _InOut):
    """Shift a column so that the smallest value seen in the fit data is 0.
    The minimum is one aggregate over the fit data and a param of the model,
    so it is kept by ``save`` and reused for other rows (test rows)."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df):
        m = df.agg(F.min(self.getInputCol())).first()[0]
        if m is None:
            raise ValueError("LabelShift: no rows to take the minimum from")
        return LabelShiftModel(minimum=float(m), inputCol=self.getInputCol(), outputCol=self.getOutputCol())


class LabelShiftModel(Model, _InOut):
    minimum = Param(Params._dummy(), "minimum", "smallest value of the fit data",
                    typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, minimum=0.0, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df):
        return df.withColumn(self.getOutputCol(),
                             F.col(self.getInputCol()).cast("double") - F.lit(self.getOrDefault(self.minimum)))
