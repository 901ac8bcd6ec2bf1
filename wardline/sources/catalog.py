"""Hospital tables from files or the catalog, literal rows, and the job over every table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.clock import Clock
from wardline.functions.clinical import bmi
from wardline.functions.dialect import money
from wardline.operators.clinical_reports import c
from wardline.operators.quality import profile_table
from wardline.operators.rows import union_all


def load_tables(spark: SparkSession, root: str, layout: dict[str, list[str]]) -> dict[str, DataFrame]:
    """Parquet tables kept as root/<schema>/<table>, keyed by (schema-qualified) name."""
    return {
        f"{schema}.{name}": spark.read.parquet(f"{root.rstrip('/')}/{schema}/{name}")
        for schema, names in layout.items()
        for name in names
    }


def catalog_tables(spark: SparkSession, schema: str) -> dict[str, DataFrame]:
    """Every table of one catalog schema, by name."""
    listed = spark.catalog.listTables(schema)
    return {t.name: spark.table(f"{schema}.{t.name}") for t in listed if t.tableType != "TEMPORARY"}


def profile_schema(spark: SparkSession, schema: str, exact: bool = False) -> DataFrame:
    """Profile of every table of a schema, over all rows."""
    tables = catalog_tables(spark, schema)
    return union_all([profile_table(df, name, exact) for name, df in sorted(tables.items())])


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: str | T.StructType) -> DataFrame:
    """A small table from literal rows, as constants of the plan."""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    if not (listed := list(rows)):
        return spark.createDataFrame([], T.StructType(fields))
    entries = [
        F.struct(*[F.lit(value).cast(field.dataType).alias(field.name) for value, field in zip(row, fields, strict=True)])
        for row in listed
    ]
    return spark.range(1).select(F.inline(F.array(*entries)))


def add_derived_columns(table: str, df: DataFrame) -> DataFrame:
    """The stored computed columns of a table: body mass index, net amount, balance due."""
    if table == "vitals":
        return df.withColumn("BMI", bmi(c("HeightInches"), c("WeightPounds")))
    if table == "billing_charges":
        return df.withColumn("NetAmount", money(c("ChargeAmount") - c("AdjustmentAmount")))
    if table == "invoices":
        return df.withColumn("BalanceDue", money(c("TotalAmount") - c("PaidAmount")))
    return df


def attach_by_mrn(rows: DataFrame, patients: DataFrame) -> DataFrame:
    """Literal rows that name a patient by record number, with the patient's id."""
    return rows.join(patients.select("MRN", "PatientID"), "MRN").drop("MRN")


def appointments_on(rows: DataFrame, patients: DataFrame, clock: Clock) -> DataFrame:
    """Literal appointments given as a day offset from today, with the patient's id."""
    dated = rows.withColumn("AppointmentDate", F.date_add(clock.today, c("DayOffset"))).drop("DayOffset")
    return attach_by_mrn(dated, patients)

