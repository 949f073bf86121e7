"""IO queries S2–S9, S11: round trips through shared storage and the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.config import DATA_DICTIONARY, RAW_COLUMNS
from cohortlens.operators import profile, synth
from cohortlens.plans import q_synth
from cohortlens.plans import sql as S
from cohortlens.plans.registry import add, materialized, raw, segmented, treated
from cohortlens.sources import io

SCHEMA_JSON = io.SCHEMA_DIR / "raw_data.json"
DATASET = "campaign"


def csv_roundtrip(s, d):
    t = treated(s, d)
    path = io.write_csv(t, io.shared_path(s, "treated_csv"))
    return io.read_csv(s, path, t.schema)


def parquet_roundtrip(s, d):
    seg = segmented(s, d)
    path = io.write_parquet(seg, io.shared_path(s, "segmented"), partition_by=["Segmentation"])
    return s.read.parquet(path)


def synthetic_write(s, d):
    out = synth.write_synthetic_dataset(q_synth.synthetic(s, d), io.shared_path(s, "synthetic"), file_format="parquet")
    return s.read.parquet(out["path"])


def warehouse_table(s, d):
    """Dataset + table from the JSON schema, synthetic rows loaded
    (overwrite, so a rerun does not duplicate)."""
    def build():
        io.create_dataset(s, DATASET)
        table = io.table_creation(s, SCHEMA_JSON, DATASET)
        io.load_table(q_synth.synthetic(s, d), table, mode="overwrite")
        return s.table(table)
    return materialized(s, d, "warehouse_table", build)


def load_table_count(s, d):
    t = warehouse_table(s, d)
    return t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("raw_data").alias("table"), "rows")


def repeated_load(s, d):
    """Customers loaded in two loads, the first of them twice as after a
    failure; rows per load."""
    io.create_dataset(s, DATASET + "_loads")
    table = io.table_creation(s, SCHEMA_JSON, DATASET + "_loads", by_load=True)
    rows = raw(s, d).select(*synth.get_synthetic_output_columns(RAW_COLUMNS))
    io.load_table(rows.where("false"), table, mode="overwrite", load_id="none")
    for load, part in (("even", 0), ("odd", 1), ("even", 0)):
        io.load_table(rows.where(F.col("ID") % 2 == part), table, load_id=load)
    return s.table(table).groupBy(F.col(io.LOAD_ID).alias("load")).agg(F.count("*").alias("rows"), F.count_distinct("ID").alias("customers"))


def schema_type_counts(s, d):
    """Declared columns and loaded non-null values per declared type."""
    decl = io.schema_frame(s, SCHEMA_JSON)
    t = warehouse_table(s, d)
    nn = t.agg(*[F.count(c).alias(c) for c in t.columns])
    long = nn.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("non_null")) for c in t.columns])).alias("x")).select("x.*")
    return F.broadcast(decl).join(long, "name").groupBy("type").agg(
        F.count(F.lit(1)).alias("n_columns"), F.sum("non_null").alias("non_null_values"))


def data_dictionary(s, d):
    """Described columns with their profile."""
    dd = s.createDataFrame(list(DATA_DICTIONARY.items()), "Column string, Description string")
    prof = profile.column_profile(raw(s, d))
    return F.broadcast(dd).join(prof, "Column").select("Column", "Description", "Type", "Unique_Values", "Nulls")


SYN = S.with_ctes(*S.base(), *q_synth.synth_ctes(), select="SELECT * FROM syn")
add("csv_roundtrip", csv_roundtrip, S.with_ctes(*S.base(), select="SELECT * FROM treated"))
add("parquet_roundtrip", parquet_roundtrip, S.with_ctes(*S.seg_base(), select="SELECT * FROM segmented"))
add("synthetic_write", synthetic_write, SYN)
add("schema_table", warehouse_table, SYN)
add("repeated_load", repeated_load, S.with_ctes(S.mart(), select=
    "SELECT CASE WHEN ID % 2 = 0 THEN 'even' ELSE 'odd' END AS load, count(*) AS rows, count(DISTINCT ID) AS customers FROM raw GROUP BY 1"))
add("load_table_count", load_table_count,
    S.with_ctes(*S.base(), *q_synth.synth_ctes(), select="SELECT 'raw_data' AS \"table\", count(*) AS rows FROM syn"))
_decl = {f["name"]: f["type"] for f in io.load_schema_fields(SCHEMA_JSON)}
add("schema_type_counts", schema_type_counts, S.with_ctes(*S.base(), *q_synth.synth_ctes(), select=
    "SELECT type, count(*) AS n_columns, CAST(sum(nn) AS BIGINT) AS non_null_values FROM (" + " UNION ALL ".join(
        f"SELECT '{t}' AS type, count({c}) AS nn FROM syn" for c, t in _decl.items()) + ") GROUP BY type"))
_types = {c: ("string" if c in ("Education", "Marital_Status") else "double" if c == "Income" else "date" if c == "Dt_Customer" else "bigint")
          for c in RAW_COLUMNS}
add("data_dictionary", data_dictionary, S.with_ctes(S.mart(), select=" UNION ALL ".join(
    f"SELECT {S.q(c)} AS \"Column\", {S.q(desc)} AS Description, {S.q(_types[c])} AS Type, "
    f"CAST(count(DISTINCT {c}) AS BIGINT) AS Unique_Values, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS Nulls FROM raw"
    for c, desc in DATA_DICTIONARY.items())))


def raw_tsv_roundtrip(s, d):
    """The raw table as the tab-separated file the reference reads,
    written to shared storage and read back with the declared schema."""
    r = raw(s, d)
    path = io.shared_path(s, "raw_tsv")
    r.write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)
    return io.read_raw_tsv(s, path, r.schema)


add("raw_tsv_roundtrip", raw_tsv_roundtrip, S.with_ctes(S.mart(), select="SELECT * FROM raw"))
