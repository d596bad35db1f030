"""Dimension builders. Each returns rows without their surrogate key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def project(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Select ``{new name: SQL expression}``."""
    return df.selectExpr(*[f"{expression} as {name}" for name, expression in columns.items()])


def versioned_dim(raw: DataFrame, columns: Mapping[str, str], end: str) -> DataFrame:
    """Distinct versions of a record; the version whose ``end`` is open is current."""
    versions = project(raw, columns).distinct()
    return versions.selectExpr("*", f"{end} is null as is_current_flag")


def snapshot_dim(raw: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Distinct records of one snapshot, all of them current and open-ended."""
    records = project(raw, columns).distinct()
    return records.selectExpr("*", "cast(null as date) as valid_to", "true as is_current_flag")


def catalog_dim(sources: Sequence[DataFrame], code: Sequence[str], label: str | None = None) -> DataFrame:
    """One row per code out of several sources, every other column by its greatest value.

    Copies of a code collapse on the map side, before anything is shuffled. The greatest text has
    no hash buffer, so texts are first grouped by, which hashes every scanned row, and only the
    few rows left are sorted for it.
    """
    together = reduce(DataFrame.unionByName, sources)
    rest = [c for c in together.columns if c not in code]
    texts = [f.name for f in together.schema if f.name in rest and isinstance(f.dataType, T.StringType)]
    others = [F.max(c).alias(c) for c in rest if c not in texts]
    variants = together.groupBy(*code, *texts).agg(F.count("*").alias("_rows"), *others)
    catalog = variants.groupBy(*code).agg(*[F.max(c).alias(c) for c in rest])
    return catalog if label is None else catalog.withColumn("source_system", F.lit(label))


def resolve_parent(
    dim: DataFrame, key: str, src: str, parent_src: str, parent_key: str, current_only: bool
) -> DataFrame:
    """Add the surrogate key of the parent record; the smallest one if several match."""
    parents = dim.where("is_current_flag") if current_only else dim
    parents = parents.groupBy(F.col(src).alias("_parent_src")).agg(F.min(key).alias(parent_key))
    return dim.join(parents, F.col(parent_src) == F.col("_parent_src"), "left").drop("_parent_src")
