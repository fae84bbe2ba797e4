"""CSV, zipped CSV and JSON-array sources, and the CSV sink."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_ROWS = 50_000


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, sentinel: str | None = "?") -> DataFrame:
    """CSV with a header; ``sentinel`` reads as null. Without a schema types are inferred (an extra scan)."""
    if str(path).lower().endswith(".zip"):
        raise ValueError("Spark reads a .zip as plain text; use read_zipped_csv")
    reader = spark.read.option("header", True)
    if sentinel is not None:
        reader = reader.option("nullValue", sentinel)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def unzip_csv(archives: DataFrame, schema: T.StructType, sentinel: str | None = "?") -> DataFrame:
    """Rows of the CSV member of each archive in ``(content binary)``; many archives are read in parallel.

    A member is decompressed and parsed in chunks, so a task holds the archive and one chunk of rows.
    """
    names = schema.names
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content in pdf["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    members = [m for m in archive.namelist() if not m.endswith("/")]
                    if len(members) != 1:
                        raise ValueError(f"expected one CSV per archive, found {members}")
                    with archive.open(members[0]) as member:
                        for chunk in pd.read_csv(member, dtype=str, keep_default_na=False, chunksize=CHUNK_ROWS):
                            yield chunk[names]

    parsed = archives.select("content").mapInPandas(run, text)
    blank = [F.lit("")] + ([F.lit(sentinel)] if sentinel is not None else [])

    def typed(f: T.StructField):
        c = F.col(f"`{f.name}`")
        return F.when(~c.isin(*blank), c).cast(f.dataType).alias(f.name)

    return parsed.select(*[typed(f) for f in schema])


def read_zipped_csv(spark: SparkSession, path: str, schema: T.StructType, sentinel: str | None = "?") -> DataFrame:
    """Zip archives under a path or glob, one CSV each."""
    return unzip_csv(spark.read.format("binaryFile").load(path), schema, sentinel)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str, one_per_line: bool = False) -> DataFrame:
    """Records of JSON arrays: one array per file, or one per line for large inputs, which split."""
    return spark.read.schema(schema).option("multiLine", not one_per_line).json(path)


def inline_rows(spark: SparkSession, rows: list[dict], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def write_csv(df: DataFrame, path: str, row_label: str | None = None, mode: str = "errorifexists") -> None:
    """CSV with a header. ``row_label`` puts that column first, as a saved row label would be."""
    if row_label is not None:
        df = df.select(f"`{row_label}`", *[f"`{c}`" for c in df.columns if c != row_label])
    df.write.mode(mode).option("header", True).csv(path)
