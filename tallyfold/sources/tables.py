"""The frames the registered queries work on, and the same frames in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.scalars import hash_key, hash_uniform


SPREAD_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def spread(scan: DataFrame) -> DataFrame:
    """Use all cores for a file that Spark would read as fewer splits than there are cores.

    Only a scan of one or a few row groups is affected; a table of many files is left as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    size = int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return scan.repartition(cores) if size > SPREAD_BYTES else scan


def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer as a census-like table.

    The given tables have no missing values, so a fixed key rule marks some as missing. ``gain`` is
    zero for nine rows in ten, as capital gains are.
    """
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    k = F.col("o_orderkey")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        k.alias("id"),
        F.col("o_totalprice").alias("total"),
        F.when(k % 13 != 0, F.col("c_acctbal")).alias("balance"),
        F.when(k % 10 == 0, F.col("o_totalprice")).otherwise(0.0).alias("gain"),
        F.when(k % 17 == 0, "?").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(k % 23 == 0, "?").otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("o_orderpriority") == "1-URGENT", " >50K").otherwise(" <=50K ").alias("income"),
    )


CENSUS_SQL = """
census AS (
  SELECT o_orderkey AS id, o_totalprice AS total,
         CASE WHEN o_orderkey % 13 <> 0 THEN c_acctbal END AS balance,
         CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice ELSE 0.0 END AS gain,
         CASE WHEN o_orderkey % 17 = 0 THEN '?' ELSE o_orderstatus END AS status,
         CASE WHEN o_orderkey % 23 = 0 THEN '?' ELSE c_mktsegment END AS segment,
         CASE WHEN o_orderpriority = '1-URGENT' THEN ' >50K' ELSE ' <=50K ' END AS income,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS y
  FROM orders JOIN customer ON o_custkey = c_custkey)
"""

LINE_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
SCORE_MODELS = ("discount", "tax", "uniform")


def line_scores(spark: SparkSession, sf_dir: str, models: tuple[str, ...] = SCORE_MODELS) -> DataFrame:
    """Score frame over lineitem: target "returned", three scores, line number as the fold.

    Two scores are heavily tied, the third has almost no ties. One scan serves all models.
    """
    p = {
        "discount": F.col("l_discount") * 10,
        "tax": F.col("l_tax") * 12.5,
        "uniform": hash_uniform(F.col("key")),
    }
    lines = table(spark, sf_dir, "lineitem")
    rows = F.array(*[F.struct(F.lit(m).alias("model"), p[m].alias("p")) for m in models])
    return (
        lines.withColumn("key", hash_key(7, *LINE_KEY))
        .select(
            "key",
            F.col("l_linenumber").alias("fold"),
            (F.col("l_returnflag") == "R").cast("int").alias("y"),
            F.inline(rows),
        )
        .withColumn("label", (F.col("p") >= 0.5).cast("int"))
    )


SCORES_SQL = """
lines AS (
  SELECT md5(concat_ws('|', '7', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate)) AS key,
         l_linenumber AS fold, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
         l_discount * 10 AS p_discount, l_tax * 12.5 AS p_tax
  FROM lineitem),
raw_scores AS (
  SELECT key, fold, y, 'discount' AS model, p_discount AS p FROM lines
  UNION ALL SELECT key, fold, y, 'tax', p_tax FROM lines
  UNION ALL SELECT key, fold, y, 'uniform',
                   CAST('0x' || substr(key, 1, 13) AS BIGINT) / 4503599627370496.0 FROM lines),
scores AS (SELECT *, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS label FROM raw_scores)
"""


def metrics_sql(cells: str, keys: str = "") -> str:
    """SQL select list of every label metric over columns tp, fp, tn, fn of ``cells``."""
    lead = f"{keys}, " if keys else ""
    return f"""
SELECT {lead}tp, fp, tn, fn,
  round(CASE WHEN tp+fp=0 OR tp+fn=0 OR tn+fp=0 OR tn+fn=0 THEN 0.0
       ELSE (tp::DOUBLE*tn - fp::DOUBLE*fn)
            / (sqrt(tp+fp)*sqrt(tp+fn)*sqrt(tn+fp)*sqrt(tn+fn)) END, 9) AS mcc,
  round((tp+tn)::DOUBLE/(tp+fp+tn+fn), 9) AS accuracy,
  round(CASE WHEN tp+fp=0 THEN 0.0 ELSE tp::DOUBLE/(tp+fp) END, 9) AS precision,
  round(CASE WHEN tp+fn=0 THEN 0.0 ELSE tp::DOUBLE/(tp+fn) END, 9) AS recall,
  round(CASE WHEN tp=0 THEN 0.0 ELSE 2.0*tp/(2.0*tp+fp+fn) END, 9) AS f1,
  round((tp::DOUBLE/(tp+fn) + tn::DOUBLE/(tn+fp))/2, 9) AS balanced_accuracy,
  round(tn::DOUBLE/(tn+fp), 9) AS specificity,
  round((tn*5.0 - fp*2.0 - fn*10.0 + tp*5.0)/(tp+fp+tn+fn), 9) AS cost_benefit_raw,
  round(((tn*5.0 - fp*2.0 - fn*10.0 + tp*5.0) - (-2.0*(tn+fp) - 10.0*(tp+fn)))
        / (5.0*(tp+fp+tn+fn) - (-2.0*(tn+fp) - 10.0*(tp+fn))), 9) AS cost_benefit
FROM {cells}"""


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with plain shape features; target: the quality label."""
    labels = table(spark, sf_dir, "labels")
    documents = table(spark, sf_dir, "documents")
    spaces = F.length("text") - F.length(F.replace(F.col("text"), F.lit(" "), F.lit("")))
    lines = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    # Measured before the join, so that texts are never exchanged.
    shapes = documents.select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        spaces.cast("double").alias("n_spaces"),
        (F.length("text") / (spaces + 1)).alias("chars_per_space"),
        lines.cast("double").alias("n_lines"),
        "lang",
        "source",
    )
    return shapes.join(labels.select("doc_id", F.col("quality").alias("y")), "doc_id")


QUALITY_NUMS = ("n_chars", "n_spaces", "chars_per_space", "n_lines")
QUALITY_CATS = ("lang", "source")
