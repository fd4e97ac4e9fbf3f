"""A mapping job described by a mapping: read a source, apply a chain of lookups, write the result."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from returnsmith.operators.lookup import apply_chain
from returnsmith.sources import bundle
from returnsmith.sources.readers import conform, normalise_nulls, read_table


def run_mapping(spark: SparkSession, job: Mapping) -> DataFrame:
    """Run a job and return what it wrote, read back.

    ``source`` is an entry for ``read_table`` (with ``schema`` and ``extra`` columns if it is to be typed, and ``null_tokens``
    if texts are to be cleaned), ``lookups`` the ``path`` and ``format`` of a lookup bundle, ``chain`` the steps, and
    ``target`` the ``path`` and ``table`` of the bundle to write.
    """
    source, target, lookups = job["source"], job["target"], job["lookups"]
    data = read_table(spark, source)
    if source.get("null_tokens") is not None:
        data = normalise_nulls(data, source["null_tokens"])
    if source.get("schema") is not None:
        data = conform(data, source["schema"], source.get("extra", ()))
    dims = bundle.read_lookups(spark, lookups["path"], fmt=lookups.get("format", "parquet"))
    bundle.write_bundle({target["table"]: apply_chain(data, job["chain"], dims)}, target["path"])
    return bundle.read_bundle(spark, target["path"], names=[target["table"]])[target["table"]]
