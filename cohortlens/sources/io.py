"""File and catalog IO.

Everything written lands under a shared location: the session's
``spark.checkpoint.dir`` (the cluster's shared folder) unless the caller names
a path. Only a local master without that setting gets a temporary folder.
"""

from __future__ import annotations

import json
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.session import ensure_checkpoint_dir

SCHEMA_DIR = Path(__file__).parent / "schemas"
# declared warehouse type → Spark type
TYPE_MAP = {"INTEGER": T.LongType(), "STRING": T.StringType(), "FLOAT": T.DoubleType(), "DATE": T.DateType()}


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh folder below the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "cohortlens-io", *parts, uuid.uuid4().hex])


def read_raw_tsv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The tab-separated raw file with a header; an explicit schema avoids
    an inference pass over the data."""
    r = spark.read.option("header", True).option("sep", "\t")
    return r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Comma CSV with header and explicit schema."""
    return spark.read.option("header", True).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> str:
    """Parquet, optionally partitioned by a column read as a filter."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def load_schema_fields(json_file: str | Path) -> list[dict]:
    with open(json_file, encoding="utf-8") as f:
        return json.load(f)


def schema_from_json(json_file: str | Path) -> T.StructType:
    """JSON field list → StructType; mode NULLABLE by default, the
    description kept as the column comment."""
    fields = []
    for fd in load_schema_fields(json_file):
        mode = fd.get("mode", "NULLABLE")
        meta = {"comment": fd.get("description", "")}
        fields.append(T.StructField(fd["name"], TYPE_MAP[fd["type"]], mode != "REQUIRED", meta))
    return T.StructType(fields)


def schema_frame(spark: SparkSession, json_file: str | Path) -> DataFrame:
    """The declared schema as a table (name, type, mode)."""
    rows = [(f["name"], f["type"], f.get("mode", "NULLABLE")) for f in load_schema_fields(json_file)]
    return spark.createDataFrame(rows, "name string, type string, mode string")


def create_dataset(spark: SparkSession, dataset: str) -> None:
    """Namespace, created when absent."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{dataset}`")


def _sql_string(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


#: Partition column of a table that keeps its loads apart.
LOAD_ID = "_load_id"


def table_creation(spark: SparkSession, json_file: str | Path, dataset: str, location: str | None = None, by_load: bool = False) -> str:
    """Create ``dataset.<file stem>`` from the JSON schema when absent;
    an existing table is left as it is. Errors propagate. ``by_load`` adds the
    partition column that :func:`load_table` needs for repeatable loads."""
    name = Path(json_file).stem
    full = f"`{dataset}`.`{name}`"
    if spark.catalog.tableExists(f"{dataset}.{name}"):
        return full
    schema = schema_from_json(json_file)
    cols = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        + (" COMMENT " + _sql_string(f.metadata["comment"]) if f.metadata.get("comment") else "")
        for f in schema.fields
    )
    loc = location or shared_path(spark, "warehouse", dataset, name)
    part = f", `{LOAD_ID}` STRING) USING parquet PARTITIONED BY (`{LOAD_ID}`)" if by_load else ") USING parquet"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({cols}{part} LOCATION '{loc}'")
    return full


def load_table(df: DataFrame, table: str, mode: str = "append", load_id: str | None = None) -> int:
    """Cast to the table's declared schema (timestamps → dates) and
    append (the service default) or overwrite; returns the table row count.

    An append that is run again after a failure would leave its rows twice. A
    table created ``by_load`` takes a ``load_id``: the rows go to that load's
    partition and replace what an earlier run of the same load left there,
    while other loads stay (``append``) or go (``overwrite``)."""
    spark = df.sparkSession
    target = spark.table(table).schema
    if (load_id is not None) != (LOAD_ID in target.names):
        raise ValueError(f"{table} {'needs' if load_id is None else 'takes no'} load_id")
    cols = []
    for f in target.fields:
        if f.name == LOAD_ID:
            cols.append(F.lit(load_id).alias(LOAD_ID))
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            c = F.to_date(c)
        cols.append(c.cast(f.dataType).alias(f.name))
    rows = df.select(*cols)
    if load_id is not None and mode == "append":
        view = f"load_{uuid.uuid4().hex}"
        rows.drop(LOAD_ID).createOrReplaceTempView(view)
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (`{LOAD_ID}` = {_sql_string(load_id)}) SELECT * FROM {view}")
        spark.catalog.dropTempView(view)
    else:
        rows.write.insertInto(table, overwrite=(mode == "overwrite"))
    spark.catalog.refreshTable(table)
    return spark.table(table).count()
