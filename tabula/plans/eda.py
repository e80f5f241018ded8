"""Exploration (O-104, O-106, O-107): expression matrix, 2-D projection, EDA composite."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import stats as S
from ..operators.encode import numeric_feature_frame
from ..operators.profile import melt
from .bias import bias_profile


def expression_matrix(long: DataFrame, sample: str, target: str, k: int = 50, bins: int = 4,
                      feature: str = "feature", value: str = "value") -> DataFrame:
    """O-107: top-k variance features as a long (feature, sample, value) matrix with annotations.

    No physical transpose: the long table *is* the feature × sample matrix. The
    target annotation is binned into ``bins`` value quantiles (duplicate edges
    dropped) over the samples.
    """
    top = S.top_variance_features(long.select(feature, value), k, feature=feature, value=value).select(feature)
    m = long.join(F.broadcast(top), feature, "left_semi")  # ≤ k rows broadcast
    samples = long.select(sample, F.col(target).cast("double").alias("__t")).distinct().withColumn("__g", F.lit(0))
    edges = S.qcut_edges(samples.where(F.col("__t").isNotNull()), bins, keys=["__g"], value="__t")
    ann = samples.join(F.broadcast(edges), "__g").select(
        sample, S.qcut_label(F.col("__t"), F.col("edges")).alias(f"{target}_binned")
    )
    return m.join(ann, sample).select(
        feature, F.col(sample).alias("sample"), value, target, f"{target}_binned"
    )


def pca_2d(df: DataFrame, id_col: str, cols: Sequence[str], k: int = 2) -> DataFrame:
    """O-104: first principal components of the numeric columns (NULL → 0, centred).

    ``StandardScaler(withMean, withStd=False)`` centres; ``PCA`` fits from the
    distributed covariance (a tree aggregate of d×d partial Gramians). Signs are
    fixed so each component's largest-magnitude loading is positive.
    """
    from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    x = numeric_feature_frame(df.select(id_col, *cols)).select(id_col, *cols)
    va = VectorAssembler(inputCols=list(cols), outputCol="__v")
    v = va.transform(x)
    sc = StandardScaler(inputCol="__v", outputCol="__c", withMean=True, withStd=False).fit(v)
    c = sc.transform(v)
    pca = PCA(k=k, inputCol="__c", outputCol="__p").fit(c)
    pc = pca.pc.toArray()
    signs = [1.0 if pc[abs(pc[:, j]).argmax(), j] >= 0 else -1.0 for j in range(k)]
    out = pca.transform(c).select(id_col, vector_to_array("__p").alias("__a"))
    return out.select(id_col, *[(F.col("__a")[j] * signs[j]).alias(f"pc{j + 1}") for j in range(k)])


def covariance_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """O-104 (exact part): sample covariance matrix of the PCA input (NULL → 0), long (col_a, col_b, cov).

    One ``ml.stat.Correlation`` pass (a distributed d×d Gramian; the input has no
    NULLs after NULL → 0) plus one pass for the standard deviations:
    cov(a, b) = corr(a, b) · sd(a) · sd(b). The d×d result is bounded by the
    column count.
    """
    from pyspark.ml.stat import Correlation

    from ..operators.model import assemble

    spark = df.sparkSession
    cols = list(cols)
    x = numeric_feature_frame(df.select(*cols)).select(*[F.col(f"`{c}`").cast("double").alias(c) for c in cols])
    sd = x.agg(*[F.stddev_samp(f"`{c}`").alias(c) for c in cols]).first()
    m = Correlation.corr(assemble(cols, "__vec").transform(x), "__vec").first()[0].toArray()
    rows = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if sd[a] is None or sd[b] is None:
                rows.append((a, b, None))
            elif i == j:
                rows.append((a, b, float(sd[a]) ** 2))
            else:
                rows.append((a, b, float(m[i, j]) * float(sd[a]) * float(sd[b])))
    return spark.createDataFrame(rows, "col_a string, col_b string, cov double")


def eda_report(df: DataFrame, id_col: str, target: str, bias_cols: Sequence[str] = (), top_n: int = 20,
               max_features: int = 50, target_bins: int = 10) -> dict[str, DataFrame]:
    """O-106: correlation, top-variance features, mutual information, bias and PCA for one use case.

    Each entry is its own lazy DataFrame; only small results reach the driver
    when they are shown or written.
    """
    numeric = target in numeric_feature_frame(df.select(target)).columns
    nums = [c for c in numeric_feature_frame(df).columns if c not in (id_col, target)]
    long = melt(df, [id_col, target], nums, var="feature")
    out = {
        "correlation": S.correlation_long(df, [*nums, target] if target in numeric_feature_frame(df).columns else nums),
        "top_variance": S.top_variance_features(long.select("feature", "value"), max_features),
        # a numeric target is cut into quantile bins; as it is, every value would be a class of its own
        "mutual_information": S.mutual_information(long, target, id_col, target_bins=target_bins if numeric else None).where(
            F.col("rank") <= top_n
        ),
        "pca": pca_2d(df, id_col, nums),
    }
    if bias_cols:
        tested = df
        if numeric:
            cut = S.qcut_values(df, id_col, [target], target_bins).select(
                F.col(id_col).alias("__id"), F.col("bin").cast("string").alias("__bin")
            )
            tested = df.join(cut, df[id_col] == cut["__id"]).drop(target, "__id").withColumnRenamed("__bin", target)
        out["bias"] = bias_profile(tested, [target], list(bias_cols))
    return out
