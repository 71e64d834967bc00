"""Training, scoring and metrics kept distributed.

Nothing here calls ``toPandas``: the split is a hash expression, the fit is one
distributed pass (moments, or triangles of a blocked factorisation that are
merged in a tree), scoring is ``transform``, and the metrics are one aggregation.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.scalar import md5_int

SPLIT_BUCKETS = 10000
NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def split_bucket(keys: Sequence[str], seed: int = 42) -> Column:
    """Repeatable bucket in [0, 10000) from md5 of the key columns and the seed."""
    k = F.concat_ws("|", *[F.col(c).cast("string") for c in keys], F.lit(str(seed)))
    return F.pmod(md5_int(k), F.lit(SPLIT_BUCKETS))


def is_test(keys: Sequence[str], test_size: float = 0.2, seed: int = 42) -> Column:
    return split_bucket(keys, seed) < F.lit(int(round(test_size * SPLIT_BUCKETS)))


def split(df: DataFrame, keys: Sequence[str], test_size: float = 0.2, seed: int = 42):
    """M1: (train, test) by md5 bucket; unlike randomSplit it survives repartitioning."""
    flag = is_test(keys, test_size, seed)
    return df.where(~flag), df.where(flag)


def split_label(df: DataFrame, target: str, exclude: Sequence[str] = ()) -> list[str]:
    """Feature columns = numeric columns other than the target (and excluded ones)."""
    return [f.name for f in df.schema.fields
            if f.name != target and f.name not in exclude
            and f.dataType.simpleString().split("(")[0] in NUMERIC]


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """Feature vectors; a row with a NULL feature keeps its place and has no vector values (NaN)."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


@dataclass
class LinearModel:
    """Fitted linear model; predictions are a plain column expression (codegen, no vectors)."""
    features: list
    coefficients: list
    intercept: float
    label: str | None = None
    n_rows: int | None = None       # rows it was fitted on
    n_dropped: int | None = None    # rows left out, as a feature or the label is missing

    def prediction(self) -> Column:
        expr = F.lit(float(self.intercept))
        for f, c in zip(self.features, self.coefficients):
            expr = expr + F.lit(float(c)) * F.col(f).cast("double")
        return expr

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("predicted", self.prediction())

    def to_row(self) -> dict:
        return {"features": list(self.features), "coefficients": [float(c) for c in self.coefficients],
                "intercept": float(self.intercept), "label": self.label}


MOMENT_FEATURES = 16      # features up to which all covariances fit one plan
WELL_CONDITIONED = 1e6    # condition number of the correlations beyond which covariances have lost too many digits
MERGE = 16                # triangles that one task merges


def train(df: DataFrame, features: Sequence[str], label: str, engine: str = "ols", reg_param: float = 0.0,
          elastic_net: float = 0.0):
    """M2: linear regression by least squares.

    Rows with a missing (null or NaN) feature or label are left out, and counted
    in the model. Engines:

    ``moments``: one aggregation of means and population covariances (Spark's
    numerically stable central-moment aggregates, partial per task); the k x k
    normal equations are solved on the driver.
    ``qr``: every task factorises its rows in Arrow blocks and keeps a triangle
    of (k + 2) squared numbers; triangles are merged in a tree, so neither the
    plan nor the driver grows with the rows, and the condition number is not
    squared as it is in covariances.
    ``ols`` (default): moments for a few features, unless they are so collinear
    that the moments do not tell them apart; else ``qr``.
    ``mllib``: ``pyspark.ml`` LinearRegression (needed for regularised fits).
    """
    feats = list(features)
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in feats + [label]])
    if engine == "mllib" or reg_param:
        lr = LinearRegression(featuresCol="features", labelCol=label, predictionCol="predicted",
                              solver="auto" if reg_param else "normal", regParam=reg_param,
                              elasticNetParam=elastic_net, fitIntercept=True)
        return lr.fit(assemble(numbers.dropna(), feats))
    if engine not in ("ols", "moments", "qr"):
        raise ValueError(f"no engine {engine!r}")
    if engine == "moments" or engine == "ols" and len(feats) <= MOMENT_FEATURES:
        model, condition = _fit_moments(numbers, feats, label)
        if engine == "moments" or condition <= WELL_CONDITIONED:
            return model
    return _fit_qr(numbers, feats, label)


def _fit_moments(numbers: DataFrame, feats: list, label: str) -> tuple[LinearModel, float]:
    """(the model, condition number of the features' correlations)."""
    import numpy as np

    k = len(feats)
    known = F.lit(True)
    for c in (*feats, label):
        known = known & F.col(f"`{c}`").isNotNull() & ~F.isnan(f"`{c}`")
    x = [F.when(known, F.col(f"`{c}`")) for c in feats]
    y = F.when(known, F.col(f"`{label}`"))
    aggs = [F.count(F.lit(1)).alias("rows"), F.count_if(known).alias("n"), F.avg(y).alias("my")]
    aggs += [F.avg(c).alias(f"m{i}") for i, c in enumerate(x)]
    aggs += [F.covar_pop(x[i], x[j]).alias(f"c{i}_{j}") for i in range(k) for j in range(i, k)]
    aggs += [F.covar_pop(c, y).alias(f"y{i}") for i, c in enumerate(x)]
    r = numbers.agg(*aggs).first()          # O(k^2) numbers, independent of the row count
    if not r["n"]:
        raise ValueError("no training rows")
    cov = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            cov[i, j] = cov[j, i] = r[f"c{i}_{j}"]
    beta = np.linalg.lstsq(cov, np.array([r[f"y{i}"] for i in range(k)]), rcond=None)[0]
    spread = np.sqrt(np.diag(cov))
    varies = spread > 0
    scaled = cov[np.ix_(varies, varies)] / np.outer(spread[varies], spread[varies])
    condition = float(np.linalg.cond(scaled)) if varies.any() else 1.0
    intercept = float(r["my"] - beta @ np.array([r[f"m{i}"] for i in range(k)]))
    return LinearModel(feats, beta.tolist(), intercept, label, r["n"], r["rows"] - r["n"]), condition


TRIANGLE = "place long, n long, dropped long, triangle binary"


def _fit_qr(numbers: DataFrame, feats: list, label: str) -> LinearModel:
    width = len(feats) + 2                                  # a column of ones, the features, the label

    def factorise(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        triangle, n, dropped = np.empty((0, width)), 0, 0
        for batch in batches:
            block = np.column_stack([np.ones(batch.num_rows), *[c.to_numpy(zero_copy_only=False) for c in batch.columns]])
            whole = ~np.isnan(block).any(axis=1)
            n, dropped = n + int(whole.sum()), dropped + int((~whole).sum())
            triangle = np.linalg.qr(np.vstack([triangle, block[whole]]), mode="r")
        yield pa.RecordBatch.from_pydict({
            "place": pa.array([TaskContext.get().partitionId()], pa.int64()), "n": pa.array([n], pa.int64()),
            "dropped": pa.array([dropped], pa.int64()), "triangle": pa.array([triangle.tobytes()], pa.binary())})

    def merge(table):
        import pyarrow as pa

        return pa.Table.from_pydict({
            "place": pa.array([table.column("place")[0].as_py() // MERGE], pa.int64()),
            "n": pa.array([sum(table.column("n").to_pylist())], pa.int64()),
            "dropped": pa.array([sum(table.column("dropped").to_pylist())], pa.int64()),
            "triangle": pa.array([_merged(table.column("triangle").to_pylist(), width).tobytes()], pa.binary())})

    triangles = numbers.mapInArrow(factorise, TRIANGLE)
    tasks = numbers.rdd.getNumPartitions()
    while tasks > MERGE:
        triangles = triangles.groupBy(F.expr(f"place div {MERGE}")).applyInArrow(merge, TRIANGLE)
        tasks = -(-tasks // MERGE)
    rows = triangles.collect()                              # at most MERGE triangles
    return _solve(_merged([r["triangle"] for r in rows], width), feats, label, sum(r["n"] for r in rows),
                  sum(r["dropped"] for r in rows))


def _merged(triangles: list, width: int):
    import numpy as np

    stacked = np.vstack([np.frombuffer(t, np.float64).reshape(-1, width) for t in triangles])
    return np.linalg.qr(stacked, mode="r")


def _solve(triangle, feats: list, label: str, n: int, dropped: int) -> LinearModel:
    """Least squares from the triangle, columns scaled to one length first; the shortest solution if it is not unique."""
    import numpy as np

    if not n:
        raise ValueError("no training rows")
    a, y = triangle[:, :-1], triangle[:, -1]
    # Centre by the column of ones: what is left below its row has the features' deviations from their means.
    length = np.linalg.norm(a[1:, 1:], axis=0)
    varies = length > 1e-13 * np.linalg.norm(a[:, 1:], axis=0)       # less is rounding of a constant column
    beta = np.zeros(len(feats))
    beta[varies] = np.linalg.lstsq(a[1:, 1:][:, varies] / length[varies], y[1:], rcond=None)[0] / length[varies]
    intercept = (y[0] - a[0, 1:] @ beta) / a[0, 0]
    return LinearModel(feats, beta.tolist(), float(intercept), label, n, dropped)


def score(model, df: DataFrame, features: Sequence[str], label: str | None = None,
          keep: Sequence[str] = (), run_id: str | None = None) -> DataFrame:
    """M3: predictions for every row (``predicted``, ``actual`` when a label is given)."""
    if isinstance(model, LinearModel):
        out = df.withColumn("predicted", model.prediction())
    else:
        cols = list(keep) + list(features) + ([label] if label and label not in keep else [])
        out = model.transform(assemble(df.select(*dict.fromkeys(cols)), features))
        # as the OLS path: no prediction where a feature is missing, and no row lost
        known = F.lit(True)
        for f in features:
            known = known & F.col(f).isNotNull()
        out = out.withColumn("predicted", F.when(known, F.col("predicted")))
    sel = [*keep, F.col("predicted").cast("double").alias("predicted")]
    if label:
        sel.append(F.col(label).cast("double").alias("actual"))
    if run_id is not None:
        sel.append(F.lit(run_id).alias("run_id"))
    return out.select(*sel)


def regression_metrics(pred: DataFrame, predicted: str = "predicted", actual: str = "actual") -> DataFrame:
    """RMSE and R^2 = 1 - SSE/SST over the rows that have both values, in one aggregation.

    ``n`` counts those rows, ``n_unscored`` the others.
    """
    both = F.col(predicted).isNotNull() & F.col(actual).isNotNull()
    seen, err = F.when(both, F.col(actual)), F.col(predicted) - F.col(actual)
    agg = pred.agg(F.count(seen).alias("n"), F.count_if(~both).alias("n_unscored"), F.sum(err * err).alias("sse"),
                   (F.var_pop(seen) * F.count(seen)).alias("sst"))
    return agg.select("n", "n_unscored", F.sqrt(F.try_divide("sse", "n")).alias("rmse"),
                      (F.lit(1.0) - F.try_divide("sse", "sst")).alias("r2"))


# ---------------------------------------------------------------- traffic split (M6)
def route(df: DataFrame, key: str, routes: Sequence[tuple[str, int]], out: str = "served_entity") -> DataFrame:
    """M6: send each key to a route by md5 bucket (0..99) against cumulative bounds.

    Percentages are integers 0..100 and must sum to 100; a 0 % route gets nothing.
    """
    total = 0
    for name, pct in routes:
        if not (isinstance(pct, int) and 0 <= pct <= 100):
            raise ValueError(f"traffic_percentage of {name!r} must be an integer in 0..100")
        total += pct
    if total != 100:
        raise ValueError(f"traffic percentages sum to {total}, not 100")
    b = F.pmod(md5_int(F.col(key)), F.lit(100))
    expr, bound = None, 0
    for name, pct in routes:
        if pct == 0:
            continue
        bound += pct
        expr = F.when(b < bound, F.lit(name)) if expr is None else expr.when(b < bound, F.lit(name))
    return df.withColumn("route_bucket", b).withColumn(out, expr)


# ---------------------------------------------------------------- scoring requests (M5)
# The four request shapes; exactly one must be set.
REQUEST_SHAPES = ("dataframe_records", "dataframe_split", "instances", "inputs")


def decode_requests(df: DataFrame, body: str = "body", request_id: str = "request_id") -> DataFrame:
    """M5: one row per input record of a scoring request log.

    One ``from_json`` per request finds the shape; the records become one
    array of (row_idx, record, ragged) built with higher-order functions and
    exploded once, so the log is read and parsed in a single pass. Records
    come out as JSON object text; ``dataframe_split`` rows are zipped with
    the column names and rows of the wrong length are kept, flagged
    ``ragged``. ``inputs`` may be any value: one that is not an array is one
    record. Every request gives a row: those with zero or several shapes, with
    no records, or with records that are not an array have a ``reject_reason``
    and no record.
    """
    shapes = F.from_json(F.col(body), "struct<" + ", ".join(f"{s}: string" for s in REQUEST_SHAPES) + ">")
    d = df.select(F.col(request_id), shapes.alias("_s"))
    n_set = sum(F.col("_s")[s].isNotNull().cast("int") for s in REQUEST_SHAPES)
    shape = F.coalesce(*[F.when(F.col("_s")[s].isNotNull(), F.lit(s)) for s in REQUEST_SHAPES])
    item = "struct<row_idx: int, record: string, ragged: boolean>"

    text = F.coalesce(F.col("_s.dataframe_records"), F.col("_s.instances"), F.col("_s.inputs"))
    is_list = F.ltrim(text).startswith("[")
    as_list = F.when(is_list, F.from_json(text, "array<string>")).when(F.col("_s.inputs").isNotNull(), F.array(text))
    listed = F.transform(as_list, lambda x, i: F.struct(i.alias("row_idx"), x.alias("record"),
                                                        F.lit(False).alias("ragged")))
    sp = F.from_json(F.col("_s.dataframe_split"), "struct<columns: array<string>, data: array<array<string>>>")

    def split_row(row, i):
        n = F.least(F.size(sp["columns"]), F.size(row))
        rec = F.to_json(F.map_from_arrays(F.slice(sp["columns"], 1, n), F.slice(row, 1, n)))
        return F.struct(i.alias("row_idx"), rec.alias("record"), (F.size(sp["columns"]) != F.size(row)).alias("ragged"))

    split_items = F.transform(sp["data"], split_row)
    reject = F.array(F.lit(None).cast(item))
    items = (F.when(F.col("_n") != 1, reject)
             .when(F.col("shape") == "dataframe_split", split_items)
             .otherwise(listed))
    reason = (F.when(F.col("_n") == 0, F.lit("no input shape set"))
              .when(F.col("_n") > 1, F.lit("more than one input shape set"))
              .when(F.col("_items").isNull(), F.concat("shape", F.lit(" is malformed")))
              .when(F.size("_items") == 0, F.lit("no records")))
    # the items are made once, in a projection of their own, and exploded from there
    made = (d.withColumn("_n", n_set).withColumn("shape", F.when(F.col("_n") == 1, shape))
            .select(request_id, "shape", "_n", items.alias("_items")))
    out = made.select(request_id, "shape", reason.alias("reject_reason"), F.explode_outer("_items").alias("_it"))
    return out.select(request_id, "shape", F.col("_it.row_idx").alias("row_idx"), F.col("_it.record").alias("record"),
                      F.coalesce(F.col("_it.ragged"), F.lit(False)).alias("ragged"), "reject_reason")


def score_requests(model, decoded: DataFrame, features: Sequence[str]) -> DataFrame:
    """M5: score decoded records, each parsed once.

    Features of an object record are read by name, those of an array record by
    position; a scalar record is the only feature.
    """
    # filter on generator outputs only: a predicate on the request-level
    # columns would be pushed below the parse and re-run it per reference
    ok = decoded.where(F.col("record").isNotNull() & ~F.col("ragged"))
    head = F.substring(F.ltrim("record"), 1, 1)
    schema = "struct<" + ", ".join(f"`{f}`: string" for f in features) + ">"
    x = ok.select("request_id", "row_idx", "record", head.alias("_head"),
                  F.when(head == "{", F.from_json("record", schema)).alias("_named"),
                  F.when(head == "[", F.from_json("record", "array<string>")).alias("_listed"))
    cols = []
    for i, f in enumerate(features):
        scalar = F.when(~F.col("_head").isin("{", "["), F.col("record")) if len(features) == 1 else F.lit(None)
        cols.append(F.coalesce(F.col("_named")[f], F.get("_listed", F.lit(i)), scalar).try_cast("double").alias(f))
    x = x.select("request_id", "row_idx", *cols)
    return score(model, x, features, keep=["request_id", "row_idx"])


# ---------------------------------------------------------------- registry (M7)
MODEL_ROW = "features array<string>, coefficients array<double>, intercept double, label string"


def save_model(model, path: str, spark=None) -> str:
    """Store a model under ``path`` (shared storage): one JSON row for OLS, MLlib format otherwise."""
    if isinstance(model, LinearModel):
        from pyspark.sql import SparkSession

        spark = spark or SparkSession.getActiveSession()
        spark.createDataFrame([model.to_row()], MODEL_ROW).coalesce(1).write.mode("overwrite").json(path + "/ols")
        return path
    model.write().overwrite().save(path + "/mllib")
    return path


def load_model(path: str, spark=None):
    from pyspark.errors import AnalysisException
    from pyspark.sql import SparkSession

    spark = spark or SparkSession.getActiveSession()
    try:
        r = spark.read.schema(MODEL_ROW).json(path + "/ols").first()
        if r is not None:
            return LinearModel(list(r["features"]), list(r["coefficients"]), r["intercept"], r["label"])
    except AnalysisException:  # not an OLS model folder
        pass
    return LinearRegressionModel.load(path + "/mllib")
