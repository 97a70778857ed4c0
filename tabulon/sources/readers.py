"""Schema-declared readers.

Cells are read as text and cast by column name, so column order in a file is
free, digit strings keep their zeros, and only the columns a query uses are
parsed. Missing-value tokens and NaN become null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.coerce import missing_to_null, to_number
from tabulon.functions.mixed_dates import to_date_any

#: Cells that mean "missing" in a delimited file.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
_TRUE, _FALSE = ["true", "1"], ["false", "0"]


def _parse(name: str, type_: T.DataType):
    text = F.col(f"`{name}`")
    present = F.when(~text.isin(MISSING_TOKENS), text)
    if isinstance(type_, T.StringType):
        return present
    if isinstance(type_, T.DateType):
        return to_date_any(present)
    if isinstance(type_, T.BooleanType):
        lowered = F.lower(F.trim(present))
        return F.when(lowered.isin(_TRUE), F.lit(True)).when(lowered.isin(_FALSE), F.lit(False))
    return to_number(present).try_cast(type_)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    drop: Sequence[str] = (),
    multi_line: bool = False,
) -> DataFrame:
    """Delimited files with a header and doubled inner quotes.

    Files whose header differs from the first one's are an error, not swapped
    values. ``multi_line`` keeps line breaks inside quotes; such files aren't
    split, so it is for small ones.
    ``drop`` names export artefacts to leave out; absent ones are ignored.
    """
    raw = spark.read.csv(path, header=True, escape='"', enforceSchema=False, multiLine=multi_line)
    missing = [f.name for f in schema if f.name not in raw.columns]
    if missing:
        raise KeyError(f"These columns are needed but absent: {missing}")
    return raw.select(*[_parse(f.name, f.dataType).alias(f.name) for f in schema if f.name not in drop])


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    return missing_to_null(spark.read.parquet(*paths))


def read_or_empty(
    spark: SparkSession, path: str, schema: T.StructType, format: str = "csv", multi_line: bool = False
) -> DataFrame:
    """An optional table: no file means no rows, with the declared schema."""
    try:
        if format == "csv":
            return read_csv(spark, path, schema, multi_line=multi_line)
        return spark.read.format(format).schema(schema).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_published_sheet(
    spark: SparkSession,
    path: str,
    columns: Mapping[str, str],
) -> DataFrame:
    """A spreadsheet exported as CSV, whose header is not on its first line.

    The header is the line whose trimmed cells hold every name in ``columns``;
    its position gives the cells to keep. Title lines above it, unit lines and
    footers stay in as rows: their date cell does not parse, so cleaning drops them.
    """
    # Quoted commas make this an upper bound of the cells in a line.
    commas = F.length("value") - F.length(F.replace("value", F.lit(","), F.lit("")))
    widest = spark.read.text(path).agg(F.max(commas)).first()[0] or 0
    width = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(widest + 1)])
    cells = spark.read.schema(width).csv(path, header=False, escape='"', mode="PERMISSIVE")
    trimmed = F.array(*[F.trim(F.col(c)) for c in width.names])
    wanted = F.array(*[F.lit(name) for name in columns])
    header = cells.filter(F.size(F.array_except(wanted, trimmed)) == 0).select(trimmed.alias("cells")).first()
    if header is None:
        raise KeyError(f"No header line holds all of {list(columns)}")
    at = {name: header["cells"].index(name) for name in columns}
    return cells.select(*[F.col(f"c{at[name]}").alias(new) for name, new in columns.items()])
