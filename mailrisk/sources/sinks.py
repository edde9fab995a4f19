"""Write result tables, reports and models."""

from __future__ import annotations

import json

import numpy as np
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailrisk.operators.learners import ForestModel
from mailrisk.operators.linear import LinearModel, MetadataScaler, load_linear_model
from mailrisk.operators.svd import SvdModel


def _is_nested(table: DataFrame) -> bool:
    return any(isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) for f in table.schema)


def write_csv(table: DataFrame, path: str) -> None:
    """CSV with header; quotes are doubled, so quoted line breaks survive."""
    table.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="")


def write_json(table: DataFrame, path: str) -> None:
    """One JSON object per row, non-ASCII text kept, null fields kept."""
    table.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def report_text(report: DataFrame) -> DataFrame:
    """Indented JSON text of every report row."""
    options = {"pretty": "true", "ignoreNullFields": "false"}
    return report.select(F.to_json(F.struct("*"), options).alias("report"))


def flat_report(report: DataFrame) -> DataFrame:
    """A report whose nested lists become texts of ``name: contribution``."""
    columns = []
    for field in report.schema:
        if isinstance(field.dataType, T.ArrayType):
            name = field.dataType.elementType.fieldNames()[0]
            column = F.array_join(
                F.transform(field.name, lambda e: F.concat_ws(": ", e[name], F.format_number(e["contribution"], 6))), "; "
            )
            columns.append(column.alias(field.name))
        else:
            columns.append(F.col(field.name))
    return report.select(*columns)


def write_results(tables: dict[str, DataFrame], folder: str, fmt: str = "csv") -> None:
    """One folder per table: CSV or parquet; nested tables as JSON rows, as
    indented JSON text and, with their lists as texts, as CSV."""
    for name, table in tables.items():
        if fmt == "parquet":
            table.write.mode("overwrite").parquet(f"{folder}/{name}")
        elif _is_nested(table):
            write_json(table, f"{folder}/{name}")
            report_text(table).write.mode("overwrite").text(f"{folder}/{name}_text")
            write_csv(flat_report(table), f"{folder}/{name}_flat")
        else:
            write_csv(table, f"{folder}/{name}")


def write_model(model: LinearModel | ForestModel, path: str) -> None:
    """Save a linear model as tables; a forest with its projection and scaler."""
    spark = SparkSession.active()
    if isinstance(model, LinearModel):
        model.save(spark, path)
        return
    carrier = LinearModel(
        model.name, model.terms, [0.0] * model.terms.size, 0.0,
        scaler=model.scaler, metadata_coefficients=[0.0] * len(model.scaler.mean),
    )
    carrier.save(spark, f"{path}/inputs")
    rows = [(i, row.tolist()) for i, row in enumerate(model.svd.components)]
    spark.createDataFrame(rows, "term_id int, component array<double>").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/components")
    header = json.dumps(model.svd.singular_values.tolist())
    spark.createDataFrame([(header,)], "singular_values string").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/singular_values")
    model.forest.write().overwrite().save(f"{path}/forest")


def load_forest_model(spark: SparkSession, path: str) -> ForestModel:
    carrier = load_linear_model(spark, f"{path}/inputs")
    rows = spark.read.parquet(f"{path}/components").orderBy("term_id").toArrow()
    components = np.array(rows["component"].to_pylist())
    values = json.loads(spark.read.parquet(f"{path}/singular_values").first()[0])
    return ForestModel(
        carrier.name, carrier.terms, SvdModel(components, np.array(values)),
        MetadataScaler(carrier.scaler.mean, carrier.scaler.scale),
        RandomForestClassificationModel.load(f"{path}/forest"),
    )
