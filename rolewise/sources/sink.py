"""Result sink: one folder per table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_tables(tables: dict[str, DataFrame], out: str, fmt: str = "parquet") -> list[str]:
    """Write every table below `out`; returns the folders."""
    paths = []
    for name, table in tables.items():
        path = f"{out.rstrip('/')}/{name}"
        table.write.mode("overwrite").format(fmt).save(path)
        paths.append(path)
    return paths
