"""Writing result tables. Failures raise."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, fmt: str = "parquet", single_file: bool = False,
                mode: str = "overwrite") -> None:
    """Write in parallel; ``single_file`` is for small results meant to be opened by hand."""
    if single_file:
        df = df.coalesce(1)
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)


def write_pack(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    """One sub-folder per result table."""
    for name, df in tables.items():
        write_table(df, f"{folder}/{name}", fmt)
