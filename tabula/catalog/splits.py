"""Bindings: ranks, bins, folds, splits, codes, samples, centring (O-22, O-23, O-48..O-56, O-110)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arrays import argmax_columns, row_sum_labels
from ..functions.numeric import r6
from ..operators import encode as E
from ..operators import scale as SC
from ..operators import split as SP
from ..operators.profile import melt
from ..session import load
from .profiles import embeddings_long
from .registry import query
from .sqlgen import EMB_LONG_SQL, long_sql
from .sqlgen import r6 as s6


@query(
    "rank_first",
    "O-48",
    "SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS BIGINT) AS rank FROM orders",
)
def q_rank_first(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return SP.rank_first(o, "o_totalprice", "o_orderkey").select("o_orderkey", "rank")


_QCUT_RANK_SQL = """WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS r,
  count(*) OVER () AS n, (SELECT least(5, greatest(2, count(DISTINCT o_totalprice))) FROM orders) AS q FROM orders
  WHERE o_totalprice IS NOT NULL)
SELECT o_orderkey, CAST(CASE WHEN n <= 1 THEN 0 ELSE greatest(((r - 1) * q + n - 2) // (n - 1) - 1, 0) END AS BIGINT) AS bin
FROM r"""


@query("qcut_rank_bins", "O-49", _QCUT_RANK_SQL)
def q_qcut_rank_bins(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return SP.qcut_rank_bins(o, "o_totalprice", "o_orderkey").select("o_orderkey", "bin")


@query(
    "stratification_label",
    "O-52",
    """SELECT doc_id, CAST(CAST(coalesce(quality, 0) + coalesce(toxic, 0) AS BIGINT) AS VARCHAR) AS multilabel_stratum,
  CASE WHEN quality IS NULL AND toxic IS NULL THEN NULL WHEN toxic > quality OR quality IS NULL THEN 'toxic'
       ELSE 'quality' END AS multiclass_stratum,
  CAST(quality AS VARCHAR) || '||' || CAST(toxic AS VARCHAR) AS text_stratum
FROM labels""",
)
def q_stratification_label(spark, sf):
    lab = load(spark, sf, "labels")
    return lab.select(
        "doc_id",
        row_sum_labels(["quality", "toxic"]).cast("string").alias("multilabel_stratum"),
        argmax_columns(["quality", "toxic"]).alias("multiclass_stratum"),
        F.concat_ws("||", F.coalesce(F.col("quality").cast("string"), F.lit("nan")),
                    F.coalesce(F.col("toxic").cast("string"), F.lit("nan"))).alias("text_stratum"),
    )


@query(
    "stratification_label_regression",
    "O-52",
    f"SELECT o_orderkey, CAST(bin AS VARCHAR) AS stratum FROM ({_QCUT_RANK_SQL}) b",
)
def q_stratification_label_regression(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    b = SP.qcut_rank_bins(o, "o_totalprice", "o_orderkey", out="stratum")
    return b.select("o_orderkey", F.col("stratum").cast("string").alias("stratum"))


@query(
    "stratified_kfold",
    "O-53",
    """WITH k AS (SELECT least(5, min(c)) AS k FROM (SELECT count(*) AS c FROM orders GROUP BY o_orderstatus))
SELECT o_orderkey, o_orderstatus, CAST((row_number() OVER (PARTITION BY o_orderstatus
  ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':42'), o_orderkey) - 1) % (SELECT k FROM k) AS BIGINT) AS fold
FROM orders""",
)
def q_stratified_kfold(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return SP.stratified_folds(o, "o_orderstatus", "o_orderkey")


@query(
    "train_val_test_split",
    "O-54",
    """WITH n AS (SELECT count(*) AS n, ceil(0.2 * count(*)) AS m FROM orders),
r AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':42'), o_orderkey) AS r
      FROM orders)
SELECT o_orderkey, CASE WHEN r <= (SELECT n - m FROM n) THEN 'train'
  WHEN r <= (SELECT n - ceil(0.5 * m) FROM n) THEN 'validation' ELSE 'test' END AS split FROM r""",
)
def q_train_val_test_split(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey")
    return SP.train_val_test_split(o, "o_orderkey")


@query(
    "first_seen_codes",
    "O-55",
    """SELECT p_brand, CAST(row_number() OVER (ORDER BY min(p_partkey), p_brand) - 1 AS BIGINT) AS code
FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand""",
)
def q_first_seen_codes(spark, sf):
    return E.first_seen_codes(load(spark, sf, "part"), "p_brand", "p_partkey")


@query(
    "label_encode",
    "O-56",
    """WITH c AS (SELECT t, row_number() OVER (ORDER BY t NULLS FIRST) - 1 AS code
  FROM (SELECT DISTINCT CAST(p_type AS VARCHAR) AS t FROM part WHERE p_size <= 40))
SELECT p.p_partkey, CAST(c.code AS BIGINT) AS code FROM part p JOIN c ON c.t = p.p_type""",
)
def q_label_encode(spark, sf):
    part = load(spark, sf, "part")
    classes = E.label_classes(part.where(F.col("p_size") <= 40), "p_type")
    return E.label_encode(part.select("p_partkey", "p_type"), classes, "p_type").select("p_partkey", "code")


@query(
    "sample_n",
    "O-110",
    "SELECT vec_id, label FROM embeddings ORDER BY md5(CAST(vec_id AS VARCHAR) || ':42'), vec_id LIMIT 100",
)
def q_sample_n(spark, sf):
    return SP.sample_n(load(spark, sf, "embeddings").select("vec_id", "label"), "vec_id", 100)


@query(
    "group_center",
    "O-51",
    f"""WITH l AS (SELECT *, CASE WHEN label = 0 THEN 'test' ELSE 'train' END AS role FROM {EMB_LONG_SQL} e),
g AS (SELECT label, feature, avg(value) AS gm FROM l WHERE role = 'train' GROUP BY label, feature),
a AS (SELECT feature, avg(value) AS am FROM l WHERE role = 'train' GROUP BY feature)
SELECT l.vec_id, l.feature, l.role,
  {s6("CASE WHEN l.role = 'train' THEN l.value - (g.gm - a.am) ELSE l.value END")} AS value
FROM l LEFT JOIN g ON g.label IS NOT DISTINCT FROM l.label AND g.feature = l.feature
LEFT JOIN a ON a.feature = l.feature""",
)
def q_group_center(spark, sf):
    long = embeddings_long(spark, sf).withColumnRenamed("feature", "column").withColumn(
        "role", F.when(F.col("label") == 0, "test").otherwise("train")
    )
    out = SC.group_center(long, "label", "role")
    return out.select("vec_id", F.col("column").alias("feature"), "role", r6("value").alias("value"))


@query(
    "apply_group_offsets",
    "O-23",
    f"""WITH l AS {EMB_LONG_SQL},
g AS (SELECT label, feature, avg(value) AS gm FROM l GROUP BY label, feature),
a AS (SELECT feature, avg(value) AS am FROM l GROUP BY feature)
SELECT l.vec_id, l.feature, {s6('l.value - (g.gm - a.am)')} AS value
FROM l JOIN g ON g.label IS NOT DISTINCT FROM l.label AND g.feature = l.feature JOIN a ON a.feature = l.feature""",
)
def q_apply_group_offsets(spark, sf):
    long = embeddings_long(spark, sf).withColumnRenamed("feature", "column")
    offsets = SC.fit_group_offsets(long, "label")
    out = SC.apply_group_offsets(long, offsets, "label")
    return out.select("vec_id", F.col("column").alias("feature"), r6("value").alias("value"))


NUM4 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "apply_params_join",
    "O-22",
    f"""WITH l AS {long_sql('lineitem', NUM4, ids=['l_orderkey', 'l_linenumber'])},
p AS (SELECT column, avg(value) AS mean, stddev_samp(value) AS std FROM l GROUP BY column)
SELECT l.l_orderkey, l.l_linenumber, l.column,
  {s6('CASE WHEN p.std > 0 THEN (l.value - p.mean) / p.std ELSE l.value END')} AS value
FROM l JOIN p USING (column)""",
)
def q_apply_params_join(spark, sf):
    long = melt(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], NUM4)
    params = long.groupBy("column").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")).select(
        "column", F.lit(SC.STANDARD).alias("decision"), F.lit(None).cast("double").alias("min"),
        F.lit(None).cast("double").alias("max"), "mean", "std", F.lit(None).cast("double").alias("median"),
        F.lit(None).cast("double").alias("iqr"),
    )
    out = SC.apply_params_long(long, params)
    return out.select("l_orderkey", "l_linenumber", "column", r6("value").alias("value"))
