"""Cleaning, assembling and ordering of rows and columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions import scalars
from tallyfold.functions.rounding import rounded
from tallyfold.operators import clean
from tallyfold.plans.registry import query
from tallyfold.sources.tables import CENSUS_SQL, census, table


@query(
    "sentinel_to_null",
    f"WITH {CENSUS_SQL} SELECT id, nullif(status, '?') AS status, nullif(segment, '?') AS segment FROM census",
)
def sentinel_to_null(spark, sf_dir):
    return clean.sentinel_to_null(census(spark, sf_dir)).select("id", "status", "segment")


@query(
    "mode_fill",
    f"""WITH {CENSUS_SQL},
    ms AS (SELECT status AS v FROM census WHERE status <> '?' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
    mg AS (SELECT segment AS v FROM census WHERE segment <> '?' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    SELECT id, coalesce(nullif(status, '?'), (SELECT v FROM ms)) AS status,
           coalesce(nullif(segment, '?'), (SELECT v FROM mg)) AS segment FROM census""",
)
def mode_fill(spark, sf_dir):
    frame = clean.sentinel_to_null(census(spark, sf_dir))
    return clean.mode_fill(frame, ["status", "segment"]).select("id", "status", "segment")


@query("label_encode", f"WITH {CENSUS_SQL} SELECT id, y FROM census")
def label_encode(spark, sf_dir):
    return clean.encode_binary(census(spark, sf_dir), "income").select("id", "y")


@query("drop_target", f"WITH {CENSUS_SQL} SELECT id, total, balance, gain, status, segment FROM census")
def drop_target(spark, sf_dir):
    return clean.drop_target(census(spark, sf_dir), "income")


@query(
    "join_blocks",
    f"WITH {CENSUS_SQL} SELECT id, total, gain, (segment = 'BUILDING')::INTEGER AS is_building FROM census",
)
def join_blocks(spark, sf_dir):
    frame = census(spark, sf_dir)
    numeric = frame.select("id", "total", "gain")
    flags = frame.select("id", (F.col("segment") == "BUILDING").cast("int").alias("is_building"))
    return clean.reorder(clean.join_blocks([numeric, flags], "id"), ["total", "id"])


@query(
    "stack_rows",
    "SELECT 'customer' AS source, c_custkey AS id, c_acctbal AS balance FROM customer UNION ALL "
    "SELECT 'supplier', s_suppkey, s_acctbal FROM supplier",
)
def stack_rows(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("source"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.lit("supplier").alias("source"), F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id")
    )
    return clean.stack_rows([customers, suppliers])


@query(
    "filter_sort",
    f"WITH {CENSUS_SQL} SELECT id, total, segment FROM census WHERE total > 250000 AND segment <> '?'",
)
def filter_sort(spark, sf_dir):
    frame = census(spark, sf_dir).where("total > 250000 and segment <> '?'")
    return frame.select("id", "total", "segment").orderBy(F.desc("total"), "id")


@query("top_20", f"WITH {CENSUS_SQL} SELECT id, total FROM census ORDER BY total DESC, id LIMIT 20")
def top_20(spark, sf_dir):
    return clean.top_k(census(spark, sf_dir).select("id", "total"), "total", 20, "id")


@query(
    "best_row",
    f"WITH {CENSUS_SQL} SELECT segment, id, gain FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY gain DESC, id) AS rn "
    "FROM census) WHERE rn = 1",
)
def best_row(spark, sf_dir):
    return clean.best_row(census(spark, sf_dir).select("segment", "id", "gain"), "gain", "id", ["segment"])


@query(
    "group_summary",
    f"WITH {CENSUS_SQL} SELECT segment, round(avg(total), 5) AS mean_total, round(stddev(total), 5) AS std_total, "
    "round(median(total), 5) AS median_total FROM census GROUP BY segment",
)
def group_summary(spark, sf_dir):
    from tallyfold.operators.order import exact_percentiles

    frame = census(spark, sf_dir)
    moments = clean.group_summary(frame, ["segment"], ["total"])
    medians = exact_percentiles(frame, ["total"], [0.5], ["segment"]).select("segment", F.col("q")[0].alias("median_total"))
    return rounded(moments.join(medians, "segment"), 5)


@query(
    "scalar_expressions",
    f"""WITH {CENSUS_SQL} SELECT id, trim(income) AS trimmed, split_part(upper(trim(income)), 'K', 1) AS head,
    contains(income, '50') AS has_50, substr(segment, 1, 4) AS prefix, CASE WHEN balance IS NOT NULL THEN least(greatest(balance, 0.0), 5000.0) END AS clipped,
    (total >= 100000)::INTEGER AS flag, round(1.0/(1.0+exp(-balance/1000.0)), 9) AS squashed,
    ceil(total/1000)::BIGINT AS thousands, list_transform(string_split('64-32', '-'), lambda s: CAST(s AS INTEGER))[1] + id AS shifted
    FROM census""",
)
def scalar_expressions(spark, sf_dir):
    return rounded(
        census(spark, sf_dir).select(
            "id",
            F.trim("income").alias("trimmed"),
            F.split(F.upper(F.trim("income")), "K").getItem(0).alias("head"),
            F.contains("income", F.lit("50")).alias("has_50"),
            scalars.preview("segment", 4).alias("prefix"),
            scalars.clip("balance", 0.0, 5000.0).alias("clipped"),
            (F.col("total") >= 100000).cast("int").alias("flag"),
            scalars.sigmoid(F.col("balance") / 1000.0).alias("squashed"),
            scalars.ceil_div("total", 1000).alias("thousands"),
            (scalars.int_list(F.lit("64-32")).getItem(0) + F.col("id")).alias("shifted"),
        )
    )
