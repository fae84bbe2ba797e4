"""Files written from the given tables by Spark and read back."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from tallyfold.plans.registry import query
from tallyfold.runtime import new_stage_path
from tallyfold.sources import files
from tallyfold.sources.tables import CENSUS_SQL, census, table


@query("csv_scan", f"WITH {CENSUS_SQL} SELECT id, total, balance, nullif(status, '?') AS status, nullif(segment, '?') AS segment FROM census")
def csv_scan(spark, sf_dir):
    frame = census(spark, sf_dir).select("id", "total", "balance", "status", "segment")
    path = new_stage_path(spark, "csv")
    files.write_csv(frame, path)
    return files.read_csv(spark, path, frame.schema)


@query("csv_row_label", "SELECT event_type, count(*) AS n, max(event_id) AS last_id FROM events GROUP BY event_type")
def csv_row_label(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    summary = events.groupBy("event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("last_id"))
    path = new_stage_path(spark, "csv_label")
    files.write_csv(summary.select("n", "last_id", "event_type"), path, row_label="event_type")
    return files.read_csv(spark, path, "event_type string, n bigint, last_id bigint")


@query("zip_csv_scan", "SELECT * FROM customer")
def zip_csv_scan(spark, sf_dir):
    """Each Arrow batch of the table becomes one archive; the archives are then scanned."""
    customer = table(spark, sf_dir, "customer")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("customer.csv", pdf.to_csv(index=False))
            yield pd.DataFrame({"content": [buffer.getvalue()]})

    return files.unzip_csv(customer.mapInPandas(pack, "content binary"), customer.schema)


@query("json_array_scan", "SELECT conv_id, turn, role, text FROM conversations")
def json_array_scan(spark, sf_dir):
    """Each Arrow batch becomes one line with a JSON array of records."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"value": [pdf.to_json(orient="records")]})

    path = new_stage_path(spark, "json")
    rows.mapInPandas(pack, "value string").write.text(path)
    return files.read_json_array(spark, path, rows.schema, one_per_line=True)
