"""A model kept as a table, and a model on top of it kept as a view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.writers import save_table, save_view, scratch_database


def model_table(source: DataFrame, table: str | None = None) -> DataFrame:
    """The source as a table, in a database of its own unless a name is given."""
    return save_table(source, table or f"{scratch_database(source.sparkSession)}.source_model")


def model_view(model: DataFrame, name: str = "first_id_model", wanted: int = 1) -> DataFrame:
    """Rows of the model with the wanted id, as a view; a NULL id is never one of them."""
    return save_view(model.filter(F.col("id") == wanted), name)
