"""Static dimensions, read once before any batch runs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from aisleflow.operators.joins import rack_category_dim


def load_dimensions(racks: DataFrame, category: DataFrame) -> DataFrame:
    """Racks with their category, kept in memory and measured.

    Counting stores the rows, so Catalyst knows their size in bytes and chooses
    the join by it. A large dimension is joined by a shuffle, which every product
    keeps small by aggregating first. The caller unpersists it.
    """
    dims = rack_category_dim(racks, category).persist()
    dims.count()
    return dims
