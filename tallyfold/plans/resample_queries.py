"""Neighbour and rebalancing queries over ``embeddings`` (label 0 against the rest)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions.rounding import rounded
from tallyfold.operators import resample
from tallyfold.operators.neighbours import knn
from tallyfold.plans.registry import query
from tallyfold.sources.tables import table


def vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("key"),
        (F.col("label") == 0).cast("int").alias("y"),
        F.col("embedding").cast("array<double>").alias("vec"),
    )


VEC_SQL = """
v AS (SELECT vec_id::VARCHAR AS key, (label = 0)::INTEGER AS y, embedding::DOUBLE[64] AS vec FROM embeddings)
"""


def knn_sql(name: str, queries: str, base: str, k: int, digits: int = 9) -> str:
    return f"""
{name} AS (SELECT key, neighbour, rank, dist FROM (
  SELECT a.key, b.key AS neighbour, round(array_distance(a.vec, b.vec), {digits}) AS dist,
         row_number() OVER (PARTITION BY a.key ORDER BY round(array_distance(a.vec, b.vec), {digits}), b.key)::INTEGER AS rank
  FROM {queries} a JOIN {base} b ON a.key <> b.key) WHERE rank <= {k})
"""


def uniform_sql(expr: str) -> str:
    return f"(CAST('0x' || substr(md5({expr}), 1, 13) AS BIGINT) / 4503599627370496.0)"


def smote_sql(base: str, seeds: str, near: str, out: str) -> str:
    """Synthetic rows from ``seeds(key, vec, copies)`` and their neighbours ``near``."""
    return f"""
{out} AS (SELECT key || '#' || copy AS key, key AS seed_key, copy, neighbour, u,
   list_transform(list_zip(vec::DOUBLE[], nvec::DOUBLE[]), lambda z: z[1] + u*(z[2]-z[1]))::DOUBLE[64] AS vec
 FROM (SELECT d.key, d.copy, d.u, d.vec, n.neighbour, b.vec AS nvec FROM (
   SELECT s.key, s.vec, c.copy::INTEGER AS copy, {uniform_sql("concat_ws('|', '42', 'step', s.key, c.copy)")} AS u,
          floor({uniform_sql("concat_ws('|', '42', 'neighbour', s.key, c.copy)")} * 5)::INTEGER AS pick
   FROM {seeds} s, LATERAL (SELECT unnest(range(1, s.copies + 1)) AS copy) c) d
  JOIN {near} n ON n.key = d.key AND n.rank = d.pick + 1 JOIN {base} b ON b.key = n.neighbour))
"""


SIZES_SQL = "sizes AS (SELECT count(*) FILTER (WHERE y=1) AS small, count(*) FILTER (WHERE y=0) AS large FROM v)"
MINOR_SQL = "minor AS (SELECT * FROM v WHERE y = 1)"


def spread_sql(source: str, out: str) -> str:
    """Equal share of the missing rows plus one for the lowest hashes."""
    return f"""
{out} AS (SELECT r.key, r.vec, ((large-small)//cnt + CASE WHEN rn <= (large-small)%cnt THEN 1 ELSE 0 END)::INTEGER AS copies
 FROM (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '42', 'copies', key))) AS rn, count(*) OVER () AS cnt
       FROM {source}) r, sizes)
"""


SMOTE_SQL = (
    f"{VEC_SQL}, {SIZES_SQL}, {MINOR_SQL}, {knn_sql('near5', 'minor', 'minor', 5)}, {spread_sql('minor', 'seeds')}, "
    f"{smote_sql('minor', 'seeds', 'near5', 'fresh')}"
)
SHOWN_SQL = "SELECT key, seed_key, neighbour, round(u, 9) AS u, round(list_sum(vec::DOUBLE[]), 6) AS total FROM fresh"
GROWN_SQL = "grown AS (SELECT key, y, vec FROM v UNION ALL SELECT key, 1 AS y, vec FROM fresh)"


def shown(rows):
    total = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x)
    return rows.select(
        "key", "seed_key", "neighbour", (F.round("u", 9) + 0.0).alias("u"), (F.round(total, 6) + 0.0).alias("total")
    )


@query("knn", f"WITH {VEC_SQL}, {knn_sql('near', 'v', 'v', 5)} SELECT * FROM near")
def knn_all(spark, sf_dir):
    frame = vectors(spark, sf_dir)
    return rounded(knn(frame, frame, 5, "key", "vec"))


@query(
    "oversample",
    f"WITH {VEC_SQL}, {SIZES_SQL}, {MINOR_SQL}, {spread_sql('minor', 'seeds')} "
    "SELECT key, unnest(range(1, copies + 1))::INTEGER AS copy FROM seeds WHERE copies > 0",
)
def oversample(spark, sf_dir):
    return resample.oversample_copies(vectors(spark, sf_dir)).select("key", "copy")


@query(
    "undersample",
    f"WITH {VEC_SQL}, {SIZES_SQL}, r AS (SELECT key, y, row_number() OVER (PARTITION BY y ORDER BY md5(concat_ws('|', '42', 'keep', key))) AS rn FROM v) "
    "SELECT key, y FROM r, sizes WHERE y = 1 OR rn <= small",
)
def undersample(spark, sf_dir):
    return resample.undersample(vectors(spark, sf_dir)).select("key", "y")


@query("smote", f"WITH {SMOTE_SQL} {SHOWN_SQL}")
def smote(spark, sf_dir):
    return shown(resample.smote_rows(vectors(spark, sf_dir)))


def share_sql(k: int) -> str:
    return (
        f"{knn_sql('near_all', 'minor', 'v', k)}, shares AS (SELECT n.key, count(*) FILTER (WHERE b.y = 0) AS others "
        "FROM near_all n JOIN v b ON b.key = n.neighbour GROUP BY n.key)"
    )


@query(
    "adasyn",
    f"WITH {VEC_SQL}, {SIZES_SQL}, {MINOR_SQL}, {knn_sql('near5', 'minor', 'minor', 5)}, {share_sql(5)}, "
    "seeds AS (SELECT m.key, m.vec, round_even(others * (large - small)::DOUBLE / (SELECT sum(others) FROM shares)::DOUBLE, 0)::INTEGER "
    f"AS copies FROM minor m JOIN shares USING (key), sizes), {smote_sql('minor', 'seeds', 'near5', 'fresh')} {SHOWN_SQL}",
)
def adasyn(spark, sf_dir):
    return shown(resample.adasyn_rows(vectors(spark, sf_dir)))


@query(
    "borderline_smote",
    f"WITH {VEC_SQL}, {SIZES_SQL}, {MINOR_SQL}, {knn_sql('near5', 'minor', 'minor', 5)}, {share_sql(10)}, "
    "danger AS (SELECT m.* FROM minor m JOIN shares USING (key) WHERE others*2 >= 10 AND others < 10), "
    f"{spread_sql('danger', 'seeds')}, {smote_sql('minor', 'seeds', 'near5', 'fresh')} {SHOWN_SQL}",
)
def borderline_smote(spark, sf_dir):
    return shown(resample.borderline_rows(vectors(spark, sf_dir)))


def link_sql(frame: str) -> str:
    return f"""{knn_sql('nn1', frame, frame, 1)},
    links AS (SELECT a.key, ya.y FROM nn1 a JOIN nn1 b ON a.neighbour = b.key AND b.neighbour = a.key
              JOIN {frame} ya ON ya.key = a.key JOIN {frame} yb ON yb.key = a.neighbour WHERE ya.y <> yb.y)"""


@query("tomek", f"WITH {VEC_SQL}, {link_sql('v')} SELECT key, y FROM v WHERE key NOT IN (SELECT key FROM links WHERE y = 0)")
def tomek(spark, sf_dir):
    return resample.resample(vectors(spark, sf_dir), "tomek").select("key", "y")


@query("smote_tomek", f"WITH {SMOTE_SQL}, {GROWN_SQL}, {link_sql('grown')} SELECT key, y FROM grown WHERE key NOT IN (SELECT key FROM links)")
def smote_tomek(spark, sf_dir):
    return resample.resample(vectors(spark, sf_dir), "smote_tomek").select("key", "y")


@query(
    "smote_enn",
    f"WITH {SMOTE_SQL}, {GROWN_SQL}, {knn_sql('nn3', 'grown', 'grown', 3)}, doomed AS (SELECT DISTINCT n.key FROM nn3 n "
    "JOIN grown a ON a.key = n.key JOIN grown b ON b.key = n.neighbour WHERE a.y <> b.y) "
    "SELECT key, y FROM grown WHERE key NOT IN (SELECT key FROM doomed)",
)
def smote_enn(spark, sf_dir):
    return resample.resample(vectors(spark, sf_dir), "smote_enn").select("key", "y")
