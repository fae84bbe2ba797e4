"""Exploratory tables over the census-like frame, parts and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions.rounding import rounded
from tallyfold.operators import profile
from tallyfold.operators.clean import encode_binary, sentinel_to_null
from tallyfold.plans.registry import query
from tallyfold.sources.tables import CENSUS_SQL, census, table

CENSUS_COLUMNS = ("id", "total", "balance", "gain", "status", "segment", "income")
CENSUS_TYPES = ("bigint", "double", "double", "double", "string", "string", "string")
NUMS = ("total", "balance", "gain")


@query(
    "class_balance",
    f"WITH {CENSUS_SQL} SELECT trim(income) AS income, count(*) AS n, "
    "round(count(*)::DOUBLE / sum(count(*)) OVER (), 9) AS share FROM census GROUP BY trim(income)",
)
def class_balance(spark, sf_dir):
    frame = census(spark, sf_dir).select(F.trim("income").alias("income"))
    return rounded(profile.proportions(frame, "income"))


@query("preview", f"WITH {CENSUS_SQL} SELECT id, total, status, segment FROM census ORDER BY id LIMIT 5")
def preview(spark, sf_dir):
    return profile.preview_rows(census(spark, sf_dir).select("id", "total", "status", "segment"), "id")


@query(
    "column_info",
    f"WITH {CENSUS_SQL} "
    + " UNION ALL ".join(
        f"SELECT {i}::INTEGER AS position, '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null FROM census"
        for i, (c, t) in enumerate(zip(CENSUS_COLUMNS, CENSUS_TYPES))
    ),
)
def column_info(spark, sf_dir):
    return profile.column_info(census(spark, sf_dir))


def _describe_sql() -> str:
    parts = []
    for i, (c, t) in enumerate(zip(CENSUS_COLUMNS, CENSUS_TYPES)):
        if t == "string":
            parts.append(
                f"SELECT {i}::INTEGER AS position, '{c}' AS \"column\", (SELECT count({c}) FROM census) AS count, "
                f"count(*) AS \"unique\", arg_max({c}, cnt) AS top, max(cnt) AS freq, NULL::DOUBLE AS mean, NULL::DOUBLE AS std, "
                "NULL::DOUBLE AS min, NULL::DOUBLE AS p25, NULL::DOUBLE AS p50, NULL::DOUBLE AS p75, NULL::DOUBLE AS max "
                f"FROM (SELECT {c}, count(*) AS cnt FROM census WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY {c})"
            )
        else:
            quart = ", ".join(f"round(quantile_cont({c}::DOUBLE, {p}), 6)" for p in (0.25, 0.5, 0.75))
            parts.append(
                f"SELECT {i}::INTEGER, '{c}', count({c}), NULL::BIGINT, NULL::VARCHAR, NULL::BIGINT, round(avg({c}), 6), "
                f"round(stddev({c}), 6), round(min({c})::DOUBLE, 6), {quart}, round(max({c})::DOUBLE, 6) FROM census"
            )
    parts.sort(key=lambda s: "AS position" not in s)
    return f"WITH {CENSUS_SQL} " + " UNION ALL ".join(parts)


@query("describe_mixed", _describe_sql())
def describe_mixed(spark, sf_dir):
    return rounded(profile.describe_mixed(census(spark, sf_dir)), 6)


@query("value_counts", "SELECT p_type, count(*) AS n FROM part GROUP BY p_type")
def value_counts(spark, sf_dir):
    return profile.value_counts(table(spark, sf_dir, "part"), "p_type")


@query("value_counts_by_key", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def value_counts_by_key(spark, sf_dir):
    return profile.value_counts(table(spark, sf_dir, "events"), "event_type", by_count=False)


@query(
    "sentinel_counts",
    f"WITH {CENSUS_SQL} SELECT * FROM (SELECT 'status' AS \"column\", count(*) FILTER (WHERE status = '?') AS n FROM census UNION ALL "
    "SELECT 'segment', count(*) FILTER (WHERE segment = '?') FROM census UNION ALL "
    "SELECT 'income', count(*) FILTER (WHERE income = '?') FROM census) WHERE n > 0",
)
def sentinel_counts(spark, sf_dir):
    return profile.sentinel_counts(census(spark, sf_dir))


@query(
    "null_counts",
    f"WITH {CENSUS_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({e}) AS nulls, (count(*) > count({e}))::INTEGER AS has_null FROM census"
        for c, e in ((c, f"nullif({c}, '?')" if t == "string" else c) for c, t in zip(CENSUS_COLUMNS, CENSUS_TYPES))
    ),
)
def null_counts(spark, sf_dir):
    return profile.null_counts(sentinel_to_null(census(spark, sf_dir)))


@query(
    "null_total",
    f"WITH {CENSUS_SQL} SELECT (3*count(*) - count(balance) - count(nullif(status, '?')) - count(nullif(segment, '?')))::BIGINT AS nulls FROM census",
)
def null_total(spark, sf_dir):
    return profile.null_total(sentinel_to_null(census(spark, sf_dir)))


def _histogram_sql(cols) -> str:
    parts = [
        f"""SELECT '{c}' AS "column", b::INTEGER AS bin, round(lo + b*((hi-lo)/30), 4) AS low, round(lo + (b+1)*((hi-lo)/30), 4) AS high,
            (SELECT count(*) FROM census WHERE {c} IS NOT NULL AND least(floor(({c} - lo)/((hi-lo)/30)), 29) = b) AS n
            FROM (SELECT min({c}) AS lo, max({c}) AS hi FROM census), range(30) t(b)"""
        for c in cols
    ]
    return f"WITH {CENSUS_SQL} " + " UNION ALL ".join(parts)


@query("histogram_30", _histogram_sql(NUMS))
def histogram_30(spark, sf_dir):
    return rounded(profile.histogram(census(spark, sf_dir), list(NUMS)), 4)


@query(
    "box_stats",
    f"WITH {CENSUS_SQL}, "
    + "long AS ("
    + " UNION ALL ".join(f"SELECT y, '{c}' AS col, {c} AS v FROM census WHERE {c} IS NOT NULL" for c in NUMS)
    + """), q AS (SELECT y, col, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
              quantile_cont(v, 0.75) AS q3 FROM long GROUP BY y, col)
    SELECT y, col AS "column", n, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
      min(v) FILTER (WHERE v BETWEEN q1 - 1.5*(q3-q1) AND q3 + 1.5*(q3-q1)) AS whisker_low,
      max(v) FILTER (WHERE v BETWEEN q1 - 1.5*(q3-q1) AND q3 + 1.5*(q3-q1)) AS whisker_high,
      count(*) FILTER (WHERE v < q1 - 1.5*(q3-q1) OR v > q3 + 1.5*(q3-q1)) AS outliers
    FROM long JOIN q USING (y, col) GROUP BY y, col, n, q1, median, q3""",
)
def box_stats(spark, sf_dir):
    frame = encode_binary(census(spark, sf_dir), "income")
    return rounded(profile.box_stats(frame, list(NUMS), "y"), 4, ("whisker_low", "whisker_high"))


@query(
    "corr_matrix",
    f"WITH {CENSUS_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 7) AS corr FROM census" for a in NUMS for b in NUMS
    ),
)
def corr_matrix(spark, sf_dir):
    return rounded(profile.correlation_matrix(census(spark, sf_dir), list(NUMS)), 7)


@query(
    "category_class_counts",
    f"WITH {CENSUS_SQL}, l AS (SELECT 'status' AS \"column\", status AS category, trim(income) AS class FROM census UNION ALL "
    "SELECT 'segment', segment, trim(income) FROM census), c AS (SELECT \"column\", category, class, count(*) AS n "
    "FROM l GROUP BY ALL) SELECT *, (sum(n) OVER (PARTITION BY \"column\", category))::BIGINT AS category_total FROM c",
)
def category_class_counts(spark, sf_dir):
    frame = census(spark, sf_dir).withColumn("income", F.trim("income"))
    return profile.category_class_counts(frame, ["status", "segment", "no_such_column"], "income")


@query(
    "crosstab_pct",
    f"WITH {CENSUS_SQL} SELECT segment, round(100.0*count(*) FILTER (WHERE y=0)/count(*), 8) AS pct_0, "
    "round(100.0*count(*) FILTER (WHERE y=1)/count(*), 8) AS pct_1 FROM census GROUP BY segment",
)
def crosstab_pct(spark, sf_dir):
    frame = encode_binary(census(spark, sf_dir), "income")
    return rounded(profile.crosstab_percent(frame, "segment", "y", [0, 1]), 8)
