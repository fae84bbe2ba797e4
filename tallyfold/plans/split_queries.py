"""Splits, folds and nested subsets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions.rounding import rounded
from tallyfold.operators import folds, split
from tallyfold.operators.clean import encode_binary, sentinel_to_null
from tallyfold.plans.registry import query
from tallyfold.runtime import stage
from tallyfold.sources.tables import CENSUS_SQL, census

# Class sizes and training rows per class: largest remainder, first class winning ties.
SPLIT_SQL = f"""{CENSUS_SQL},
sizes AS (SELECT y, count(*) AS n FROM census GROUP BY y),
shares AS (SELECT y, n, (sum(n) OVER () - ceil(0.5*sum(n) OVER ()))::DOUBLE * n / sum(n) OVER () AS exact,
                  sum(n) OVER () - ceil(0.5*sum(n) OVER ()) AS n_train FROM sizes),
takes AS (SELECT y, floor(exact) + CASE WHEN row_number() OVER (ORDER BY round(exact - floor(exact), 9) DESC, y)
                  <= n_train - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS take FROM shares),
ranked AS (SELECT id, y, row_number() OVER (PARTITION BY y ORDER BY md5(concat_ws('|', '42', id))) AS rn FROM census),
halves AS (SELECT id, y, CASE WHEN rn <= take THEN 'train' ELSE 'test' END AS split FROM ranked JOIN takes USING (y))
"""


def labelled(spark, sf_dir):
    return encode_binary(census(spark, sf_dir), "income")


@query("strat_split", f"WITH {SPLIT_SQL} SELECT id, y, split FROM halves")
def strat_split(spark, sf_dir):
    return split.stratified_split(labelled(spark, sf_dir).select("id", "y"), ["id"], "y")


@query(
    "split_report",
    f"WITH {SPLIT_SQL} SELECT split, y, count(*) AS n, round(count(*)::DOUBLE/sum(count(*)) OVER (PARTITION BY split), 9) AS share "
    "FROM halves GROUP BY split, y",
)
def split_report(spark, sf_dir):
    halves = split.stratified_split(labelled(spark, sf_dir).select("id", "y"), ["id"], "y")
    return rounded(split.split_report(halves))


# Folds as rows (id, y, repeat, fold): dealt to classes like cards, in the order of a hash.
def folds_sql(k: int = 5, repeats: int = 3) -> str:
    return f"""
    r AS (SELECT id, y, rep::INTEGER AS repeat, md5(concat_ws('|', '42', rep, id)) AS h FROM census, range(1, {repeats + 1}) t(rep)),
    sizes AS (SELECT y, n, sum(n) OVER (ORDER BY y) - n AS s FROM (SELECT y, count(*) AS n FROM census GROUP BY y)),
    dealt AS (SELECT y, i, floor((s+n-i+{k - 1})/{k}.0) - floor((s-i+{k - 1})/{k}.0) AS c FROM sizes, range({k}) t(i)),
    ends AS (SELECT y, i, sum(c) OVER (PARTITION BY y ORDER BY i) AS last FROM dealt),
    k AS (SELECT id, y, repeat, row_number() OVER (PARTITION BY repeat, y ORDER BY h) AS rn FROM r),
    folds AS (
      SELECT id, y, repeat, (1 + count(*) FILTER (WHERE rn > last))::INTEGER AS fold FROM k JOIN ends USING (y) GROUP BY id, y, repeat)
"""


@query("kfold_assign", f"WITH {CENSUS_SQL}, {folds_sql()} SELECT id, y, repeat, fold FROM folds")
def kfold_assign(spark, sf_dir):
    return split.repeated_folds(labelled(spark, sf_dir).select("id", "y"), ["id"], "y", 5, 3)


@query(
    "nested_subsets",
    f"""WITH {CENSUS_SQL}, n AS (SELECT count(*) AS n FROM census),
    k AS (SELECT id, row_number() OVER (ORDER BY md5(concat_ws('|', '42', id))) AS rn FROM census),
    e AS (SELECT i, floor((0.3 + 0.7*i/4) * n + 1e-9) AS last FROM n, range(5) t(i))
    SELECT id, (1 + count(*) FILTER (WHERE rn > last))::INTEGER AS subset FROM k, e GROUP BY id""",
)
def nested_subsets(spark, sf_dir):
    sizes = split.training_sizes(0.3, 1.0, 5)
    return split.nested_subsets(census(spark, sf_dir).select("id"), ["id"], sizes)


# Quartiles are those of the training rows once their missing numbers have become the training median.
@query(
    "fold_preprocessing",
    f"""WITH {CENSUS_SQL}, {folds_sql()},
    train AS (
      SELECT f.repeat, g.fold::INTEGER AS fold, c.* FROM census c JOIN folds f USING (id) JOIN range(1, 6) g(fold) ON f.fold <> g.fold),
    numbers AS (
      SELECT repeat, fold, 'total' AS "column", total AS v FROM train UNION ALL SELECT repeat, fold, 'balance', balance FROM train
      UNION ALL SELECT repeat, fold, 'gain', gain FROM train),
    medians AS (SELECT repeat, fold, "column", quantile_cont(v, 0.5) AS m FROM numbers GROUP BY ALL),
    filled AS (SELECT repeat, fold, "column", m, coalesce(v, m) AS v FROM numbers JOIN medians USING (repeat, fold, "column")),
    strings AS (
      SELECT repeat, fold, 'status' AS "column", nullif(status, '?') AS v FROM train
      UNION ALL SELECT repeat, fold, 'segment', nullif(segment, '?') FROM train),
    counted AS (SELECT repeat, fold, "column", v, count(*) AS n FROM strings WHERE v IS NOT NULL GROUP BY ALL)
    SELECT repeat, fold, "column", round(max(m), 6) AS median, round(quantile_cont(v, 0.25), 6) AS q1, round(quantile_cont(v, 0.75), 6) AS q3,
           NULL::VARCHAR AS mode, NULL::INTEGER AS n_categories FROM filled GROUP BY ALL
    UNION ALL
    SELECT repeat, fold, "column", NULL, NULL, NULL, first(v ORDER BY n DESC, v), count(*)::INTEGER FROM counted GROUP BY ALL""",
)
def fold_preprocessing(spark, sf_dir):
    """What the training rows of 5 x 3 folds fit to, all folds in one pass."""
    marked = folds.fold_array(sentinel_to_null(labelled(spark, sf_dir)), ["id"], "y", 5, 3)
    rows = stage(marked.drop("income", "y"), "folds")
    table = folds.complement_table(rows, ["total", "balance", "gain"], ["status", "segment"], folds.cells_of(5, 3))
    return rounded(table, 6)
