"""File sources: bulk CSV, seeds, file drops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# The format each extension stands for.
FORMAT_BY_EXTENSION = {".csv": "csv", ".jsonl": "jsonl", ".ndjson": "jsonl", ".parquet": "parquet"}
SPARK_FORMAT = {"csv": "csv", "jsonl": "json", "parquet": "parquet"}
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def drop_format(file_glob: str, fmt: str | None = None) -> str:
    """The format asked for, else the one the pattern's ending stands for."""
    name = file_glob.lower()
    chosen = fmt or next((f for ending, f in FORMAT_BY_EXTENSION.items() if name.endswith(ending)), None)
    if chosen is None:
        raise ValueError(f"no format known for {file_glob!r}; set 'format' (csv | jsonl | parquet)")
    if chosen not in SPARK_FORMAT:
        raise ValueError(f"unknown format {chosen!r}; allowed: {', '.join(SPARK_FORMAT)}")
    return chosen


def _options(fmt: str) -> dict[str, str]:
    if fmt == "csv":
        return {"header": "true", "timestampNTZFormat": TIMESTAMP_TEXT}
    return {"timestampNTZFormat": TIMESTAMP_TEXT} if fmt == "jsonl" else {}


def read_bulk_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Columns are bound by position under the header line, and one bad row fails the load."""
    reader = spark.read.schema(schema).options(**_options("csv"))
    return reader.option("enforceSchema", True).option("mode", "FAILFAST").csv(path)


def read_drops(spark: SparkSession, path: str, file_glob: str = "*", fmt: str | None = None,
               schema: StructType | str | None = None, streaming: bool = False) -> DataFrame:
    """All files of a folder that match the glob. Streams need a schema."""
    chosen = drop_format(file_glob, fmt)
    reader = (spark.readStream if streaming else spark.read).format(SPARK_FORMAT[chosen])
    reader = reader.options(**_options(chosen)).option("pathGlobFilter", file_glob)
    if schema is not None:
        reader = reader.schema(schema)
    elif chosen == "csv":
        reader = reader.option("inferSchema", True)
    return reader.load(path)


def load_seed(lake, name: str, path: str, schema: StructType | str | None = None, layer: str = "staging") -> None:
    """A CSV file with a header as a table, replaced by every run; types are inferred if not declared.

    A seed is a small reference file; inferring its types reads it twice.
    """
    rows = read_drops(lake.spark, path, "*.csv", schema=schema)
    lake.replace(layer, name, rows)


def write_drops(df: DataFrame, path: str, fmt: str) -> None:
    df.write.format(SPARK_FORMAT[fmt]).options(**_options(fmt)).save(path)
