"""Readers and the clean-up every raw table goes through."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructType

from returnsmith.functions.nulls import tokens_to_null
from returnsmith.schemas import NULL_TOKENS


def read_table(spark: SparkSession, source: Mapping, schema: StructType | None = None) -> DataFrame:
    """Read the table a config entry describes: ``type`` parquet, csv, jdbc, table or sql.

    ``options`` go to the reader. JDBC reads run in parallel when the options hold
    ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``.
    """
    kind = str(source.get("type", "")).lower()
    options = dict(source.get("options", {}))
    if kind == "table":
        return spark.table(source["name"])
    if kind == "sql":
        return spark.sql(source["query"], args=source.get("params"))
    if kind not in ("parquet", "csv", "jdbc"):
        raise ValueError(f"unsupported source type: {source.get('type')!r}")
    reader = spark.read.format(kind)
    if kind == "jdbc":
        return reader.options(**options).load()
    if kind == "csv":
        options = {"header": "true", "encoding": "utf-8", **options}
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load(source["path"])


def clean_header(df: DataFrame) -> DataFrame:
    """Column names without a '.N' repeat suffix and without outer blanks."""
    names = [str(n).split(".")[0].strip() for n in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"columns equal after clean-up: {twice}")
    return df.toDF(*names)


def normalise_nulls(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS,
                    cols: Sequence[str] | None = None) -> DataFrame:
    """Null for every text value the sources use as "no value"."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    changed = set(text if cols is None else cols)
    return df.selectExpr(*[f"{tokens_to_null(n, tokens)} AS {n}" if n in changed else n for n in df.columns])


def conform(df: DataFrame, schema: StructType, extra: Sequence[str] = ()) -> DataFrame:
    """The columns of ``schema`` in its order and types, plus ``extra`` as they are; the scan reads
    nothing else."""
    missing = [n for n in [*schema.names, *extra] if n not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")
    return df.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields], *extra)
