"""Type-aware preparation fitted on training rows only.

Numbers: exact median for missing values, then centred and divided by the
population deviation. Categories: most frequent for missing values, then one
indicator per known category, all zeros for an unknown one. The fitted model is
an ordinary PipelineModel of built-in stages, so saving and loading need nothing
from this library.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.operators.quantiles import exact_medians, text_modes


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _number(value: float) -> str:
    return f"CAST({_text(repr(float(value)))} AS DOUBLE)"


def _present(name: str) -> Column:
    x = F.col(_quoted(name)).cast("double")
    return F.when(~F.isnan(x), x)


def numeric_fills(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, median, mean, std): medians, and the moments after filling with them.

    One scan for quantiles, one for both moments: filling m missing values with a
    known median shifts sums in closed form.
    """
    medians = exact_medians(df, columns)
    parts = [
        F.struct(F.lit(c).alias("column"), F.count(F.lit(1)).alias("rows"), F.count(_present(c)).alias("n"),
                 F.avg(_present(c)).alias("avg"), F.var_pop(_present(c)).alias("var"))
        for c in columns
    ]
    raw = df.agg(F.array(*parts).alias("p")).select(F.inline("p"))
    joined = raw.join(medians.drop("n"), "column")
    share = F.col("n") / F.col("rows")
    gap = F.col("median") - F.col("avg")
    variance = F.col("var") * share + gap * gap * share * (1 - share)
    return joined.select(
        "column", "median",
        (F.col("avg") + gap * (1 - share)).alias("mean"),
        F.sqrt(F.greatest(variance, F.lit(0.0))).alias("std"),
    )


class TabularPreparer(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the preparation described in this module; columns stay in the given order."""

    numericCols = Param(Params._dummy(), "numericCols", "numeric input columns", TypeConverters.toListString)
    categoricalCols = Param(
        Params._dummy(), "categoricalCols", "categorical input columns", TypeConverters.toListString
    )
    outputCol = Param(Params._dummy(), "outputCol", "feature vector column", TypeConverters.toString)

    def __init__(self, numericCols=(), categoricalCols=(), outputCol="features"):
        super().__init__()
        self._set(numericCols=list(numericCols), categoricalCols=list(categoricalCols), outputCol=outputCol)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        numeric = self.getOrDefault(self.numericCols)
        categorical = self.getOrDefault(self.categoricalCols)
        # A handful of fitted constants per column is all that reaches the driver.
        fills = {r["column"]: r for r in numeric_fills(dataset, numeric).collect()} if numeric else {}
        common = {r["column"]: r["mode"] for r in text_modes(dataset, categorical).collect()} if categorical else {}
        # A column without a single value carries no information and is left out.
        numeric = [c for c in numeric if c in fills]
        categorical = [c for c in categorical if c in common]

        selects = []
        for c in numeric:
            f = fills[c]
            filled = f"coalesce(nanvl(CAST({_quoted(c)} AS DOUBLE), NULL), {_number(f['median'])})"
            divisor = f["std"] if f["std"] > 0 else 1.0
            selects.append(f"({filled} - {_number(f['mean'])}) / {_number(divisor)} AS {_quoted('num_' + c)}")
        for c in categorical:
            selects.append(
                f"coalesce(CAST({_quoted(c)} AS STRING), {_text(common[c])}) AS {_quoted('cat_' + c)}"
            )
        fill = SQLTransformer(statement=f"SELECT *, {', '.join(selects)} FROM __THIS__")
        stages, made = [fill], [f"num_{c}" for c in numeric] + [f"cat_{c}" for c in categorical]
        inputs = [f"num_{c}" for c in numeric]
        if categorical:
            index = StringIndexer(
                inputCols=[f"cat_{c}" for c in categorical], outputCols=[f"idx_{c}" for c in categorical],
                handleInvalid="keep", stringOrderType="alphabetAsc",
            ).fit(fill.transform(dataset))
            encode = OneHotEncoder(
                inputCols=[f"idx_{c}" for c in categorical], outputCols=[f"hot_{c}" for c in categorical],
                dropLast=True, handleInvalid="error",
            ).fit(index.transform(fill.transform(dataset)))
            stages += [index, encode]
            made += [f"{p}_{c}" for p in ("idx", "hot") for c in categorical]
            inputs += [f"hot_{c}" for c in categorical]
        out = self.getOrDefault(self.outputCol)
        stages.append(VectorAssembler(inputCols=inputs, outputCol=out))
        stages.append(SQLTransformer(
            statement=f"SELECT * EXCEPT ({', '.join(_quoted(c) for c in made)}) FROM __THIS__"
        ))
        return PipelineModel(stages)
