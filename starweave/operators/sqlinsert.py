"""INSERT INTO ... SELECT by column position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starweave.specs import TableSpec


def insert_select(spark: SparkSession, target: str, spec: TableSpec, select: str, **sources: DataFrame) -> DataFrame:
    """Rows of ``select`` matched to the target's columns *by position*.

    ``{name}`` in the SQL stands for the DataFrame passed under that name.
    """
    if spec.schema is None:
        raise ValueError(f"table {spec.name} declares no columns")
    rows = spark.sql(select, **sources)
    if len(rows.columns) != len(spec.schema.names):
        raise ValueError(f"{target} has {len(spec.schema.names)} columns, the query gives {len(rows.columns)}")
    typed = rows.toDF(*spec.schema.names).selectExpr(
        *[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in spec.schema.fields]
    )
    typed.createOrReplaceTempView(target)
    return typed
