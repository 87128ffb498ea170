"""Preprocessing and ridge regression on Spark ML.

Equivalent of the reference's ColumnTransformer + Ridge:

* numeric columns: exact median imputation (G1) then standardisation with
  the population standard deviation (G3) — statistics come from two small
  aggregate passes (one value per column) and are applied as literals;
* categorical columns: most-frequent imputation with ties to the smallest
  value (G2), then ``StringIndexer(handleInvalid="keep")`` +
  ``OneHotEncoder(dropLast=True)`` so unseen/NULL categories become the
  all-zero vector, like ``handle_unknown="ignore"`` (G4);
* one Gram matrix of all transformed features, the target and a column of
  ones (XᵀX, Xᵀy, yᵀy, sums): summed over blocks of rows in one pass on the
  executors (tree aggregation), which sums up means and scales too. Any number of fits — ablations, penalties —
  solve a sub-matrix of it on the driver (G6, G12), sklearn's ``Ridge(alpha)``
  closed form with an unpenalised intercept.

Scoring (G7) is one expression of the imputed columns and category indices, so
that several models score the same row in one pass; explanations (H5, E11) are
column expressions over the assembled vector.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written
from .quantiles import quantile_selection

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
                 T.BooleanType)


def column_roles(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Numeric vs categorical columns by type, other columns dropped."""
    numeric, categorical = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, NUMERIC_TYPES):
            numeric.append(f.name)
        elif isinstance(f.dataType, T.StringType):
            categorical.append(f.name)
    return numeric, categorical


@dataclass
class Preprocessing:
    numeric: list[str]
    categorical: list[str]
    medians: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    scales: dict[str, float] = field(default_factory=dict)
    #: each categorical column's values, sorted
    labels: dict[str, list[str]] = field(default_factory=dict)

    def imputed(self, df: DataFrame, missing: str = "pipeline") -> DataFrame:
        """Impute with the fitted statistics, or zero-fill (the diagnostics' ``fillna(0)``, G8)."""
        cols: dict[str, Column] = {}
        for c in self.numeric:
            x = F.col(c).cast("double") if c in df.columns else F.lit(None).cast("double")
            x = F.when(F.isnan(x), None).otherwise(x)
            fill = 0.0 if missing == "zero" else self.medians.get(c)
            cols[c] = F.coalesce(x, F.lit(fill).cast("double"))
        for c in self.categorical:
            x = F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
            fill = "0" if missing == "zero" else self.modes.get(c)
            cols[c] = F.coalesce(x, F.lit(fill).cast("string"))
        return df.withColumns(cols)

    def transform(self, df: DataFrame, missing: str = "pipeline") -> DataFrame:
        """Imputed + standardised numeric columns (``__z_<name>``) and imputed categories."""
        d = self.imputed(df, missing)
        return d.withColumns({f"__z_{c}": (F.col(c) - F.lit(self.means[c])) / F.lit(self.scales[c])
                              for c in self.numeric})


#: Categories a column may have: their list and one coefficient each come to the driver.
MAX_CATEGORIES = 10_000


def fit_preprocessing(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                      accuracy: int | None = None, max_categories: int = MAX_CATEGORIES) -> Preprocessing:
    """Two aggregate passes: medians + modes, then mean / population std of the
    imputed numerics (as the reference's scaler sees imputed values). A column with more
    than ``max_categories`` categories is an error, raised before any list is collected:
    collapse its rare ones first (E8)."""
    p = _fit_filling(train, numeric, categorical, accuracy, max_categories)
    if numeric:
        imp = p.imputed(train.select(*numeric))
        row = imp.agg(*[F.avg(c).alias(f"a{i}") for i, c in enumerate(numeric)],
                      *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(numeric)]).first()
        p.means = {c: float(row[f"a{i}"] or 0.0) for i, c in enumerate(numeric)}
        # zero variance → scale 1 (the standardised column is then all zeros)
        p.scales = {c: (float(row[f"s{i}"]) if row[f"s{i}"] else 1.0) for i, c in enumerate(numeric)}
    return p


def _fit_filling(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], accuracy: int | None = None,
                 max_categories: int = MAX_CATEGORIES) -> Preprocessing:
    """Medians, modes and categories; means and scales are still to come."""
    p = Preprocessing(list(numeric), list(categorical))
    if numeric:
        # all columns' medians in one selection
        if accuracy is None:
            meds = {r["statistic"]: r["q"] for r in quantile_selection(train, {c: ([], c, [0.5]) for c in numeric}).collect()}
        else:
            x = {c: F.col(c).cast("double") for c in numeric}
            row = train.agg(*[F.percentile_approx(F.when(~F.isnan(x[c]), x[c]), 0.5, accuracy).alias(c) for c in numeric]).first()
            meds = row.asDict()
        p.medians = {c: (float(meds[c]) if meds.get(c) is not None else 0.0) for c in numeric}
    if categorical:
        p.modes, p.labels = category_values(train, categorical, max_categories)
    return p


def category_values(df: DataFrame, cols: Sequence[str],
                    max_values: int | None = None) -> tuple[dict[str, str | None], dict[str, list[str]]]:
    """Per column, the most frequent non-NULL value, ties → smallest (sklearn ``most_frequent``)
    (G2), and all its values in order.

    Counts per (column, value) with map-side combine, written; the top-1 is a bounded
    aggregate per column. More than ``max_values`` distinct values in a column are an error,
    raised before their list is collected."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("string").alias("v"))
                                         for c in cols])).alias("s")).select("s.k", "s.v").where(
        F.col("v").isNotNull())
    counts = written(long.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")), "category-counts")
    # min_by keeps one candidate per column (bounded state, partial aggregation)
    best = counts.groupBy("k").agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("v"),
                                    F.count(F.lit(1)).alias("values")).collect()
    wide = {r["k"]: r["values"] for r in best if max_values is not None and r["values"] > max_values}
    if wide:
        raise ValueError(f"more than {max_values} categories in {wide}; collapse rare ones or leave the columns out")
    labels: dict[str, list[str]] = {c: [] for c in cols}
    for r in counts.select("k", "v").collect():
        labels[r["k"]].append(r["v"])
    found = {r["k"]: r["v"] for r in best}
    return {c: found.get(c) for c in cols}, {c: sorted(v) for c, v in labels.items()}


def most_frequent(df: DataFrame, cols: Sequence[str], max_values: int | None = None) -> dict[str, str | None]:
    """Most frequent non-NULL value per column, ties → smallest."""
    return category_values(df, cols, max_values)[0]


@dataclass
class RidgeModel:
    prep: Preprocessing
    pipeline: PipelineModel
    feature_names: list[str]
    coefficients: list[float]
    intercept: float
    alpha: float
    n_train: int
    label_std: float = 0.0
    category_labels: dict[str, list[str]] = field(default_factory=dict)

    def indexed(self, df: DataFrame, missing: str = "pipeline") -> DataFrame:
        """Standardised columns and category indices: what :meth:`prediction` reads."""
        indexers = [s for s in self.pipeline.stages if isinstance(s, StringIndexerModel)]
        return PipelineModel(indexers).transform(self.prep.transform(df, missing))

    def prediction(self) -> Column:
        """Intercept + Σ coefficient · feature, over :meth:`indexed` rows. A category's
        coefficient is looked up by its index; unseen ones have none."""
        by_source: dict[str, list[float]] = {}
        for c, w in zip(self.source_columns(), self.coefficients):
            by_source.setdefault(c, []).append(float(w))
        total = F.lit(float(self.intercept))
        for c in self.prep.numeric:
            total = total + F.lit(by_source[c][0]) * F.col(f"__z_{c}")
        for c in self.prep.categorical:
            if c in by_source:
                table = F.from_json(F.lit(json.dumps(by_source[c])), "array<double>")
                total = total + F.coalesce(F.get(table, F.col(f"__idx_{c}").cast("int")), F.lit(0.0))
        return total

    def _without_parts(self, df: DataFrame) -> DataFrame:
        return df.drop("__features", *[f"__z_{c}" for c in self.prep.numeric],
                       *[f"__idx_{c}" for c in self.prep.categorical], *[f"__oh_{c}" for c in self.prep.categorical])

    def predict(self, df: DataFrame, out: str = "pred_log", missing: str = "pipeline") -> DataFrame:
        """Batch prediction in log space."""
        return self.predict_all(df, {out: self}, missing)

    def predict_all(self, df: DataFrame, models: Mapping[str, RidgeModel], missing: str = "pipeline") -> DataFrame:
        """The predictions of several models in the columns that name them, from one pass.
        Their inputs are among this model's, with the same statistics (one :class:`Gram`)."""
        x = self.indexed(df, missing).withColumns({out: m.prediction() for out, m in models.items()})
        return self._without_parts(x)

    def assembled(self, df: DataFrame, missing: str = "pipeline") -> DataFrame:
        """All transformed features as the vector ``__features``, and ``__pred``."""
        x = self.prep.transform(df, missing)
        return self.pipeline.transform(x).withColumn("__pred", self.prediction())

    def coefficient_frame(self, spark) -> DataFrame:
        rows = list(zip(self.feature_names, [float(c) for c in self.coefficients]))
        return spark.createDataFrame(rows, "feature string, coef double")

    def contributions(self, df: DataFrame, top_k: int = 3, missing: str = "pipeline") -> DataFrame:
        """Per-row local explanation: top-k positive and negative contributions
        (transformed feature × coefficient), intercept as baseline (H5, E11).

        Each entry names its source column and that column's value as text (H6): the
        input of a numeric column (0 for a missing one with ``missing="zero"``, else
        NULL) and the category a one-hot column stands for."""
        fill = F.lit(0.0 if missing == "zero" else None).cast("double")
        given = [F.coalesce(F.col(f"`{c}`").cast("double"), fill) if c in df.columns else fill
                 for c in self.prep.numeric]
        x = df.withColumn("__given", F.array(*given) if given else F.array().cast("array<double>"))
        x = self.assembled(x, missing)
        table = F.from_json(F.lit(self._feature_table()), "array<struct<name:string,source:string,level:string,coef:double>>")
        coefs = F.from_json(F.lit(json.dumps([float(c) for c in self.coefficients])), "array<double>")
        # numbers are ranked (ties: in the features' order), both signs at once; only the first ones get their texts
        sizes = F.transform(F.zip_with(coefs, "__dense", lambda w, v: w * v),
                            lambda c, i: F.struct(F.abs(c).alias("size"), (-i).alias("back"), c.alias("c")))
        ranked = F.sort_array(F.filter(sizes, lambda e: e["c"] != 0), asc=False)

        def entry(e):
            feature = F.get(table, -e["back"])
            return F.struct(feature["name"].alias("transformed_feature"), feature["source"].alias("feature"),
                            F.coalesce(feature["level"], F.get("__given", -e["back"]).cast("string")).alias("feature_value"),
                            e["c"].alias("contribution_log"))

        def top(cond):
            return F.transform(F.slice(F.filter("__ranked", lambda e: cond(e["c"])), 1, top_k), entry)
        x = x.withColumn("__dense", vector_to_array("__features")).withColumn("__ranked", ranked)
        return x.withColumns({
            "baseline_log_value": F.lit(float(self.intercept)),
            "top_positive": top(lambda c: c > 0),
            "top_negative": top(lambda c: c < 0),
        }).withColumnRenamed("__pred", "pred_log").drop("__given", "__dense", "__ranked").transform(self._without_parts)

    def _feature_table(self) -> str:
        """Name, source column, category and coefficient of each transformed feature, as
        JSON: one literal in a plan, whatever the number of features."""
        levels = [None] * len(self.prep.numeric) + [v for c in self.prep.categorical for v in self.category_labels[c]]
        return json.dumps([{"name": n, "source": s, "level": v, "coef": float(k)} for n, s, v, k in zip(
            self.feature_names, self.source_columns(), levels, self.coefficients)])

    def source_columns(self) -> list[str]:
        """Source column of each transformed feature."""
        return list(self.prep.numeric) + [c for c in self.prep.categorical for _ in self.category_labels[c]]

    def normal_equations(self, df: DataFrame, target: str) -> DataFrame:
        """(feature, transformed_feature, gradient) of the ridge loss on ``df``, per row:
        Σ x·(y − ŷ)/n − α·w/n, and Σ (y − ŷ)/n for the intercept. All are zero on the
        training rows. One aggregate of a feature's sum each, no row leaves its task."""
        x = self.assembled(df.where(F.col(target).isNotNull()))
        r = F.col(target) - F.col("__pred")
        parts = x.select(F.posexplode(F.concat(vector_to_array("__features"), F.array(F.lit(1.0)))).alias("i", "x"),
                         r.alias("r"))
        sums = parts.groupBy("i").agg(F.sum(F.col("x") * F.col("r")).alias("s"), F.count(F.lit(1)).alias("n"))
        names = [(i, s, n, self.alpha * float(w)) for i, (s, n, w) in enumerate(
            zip([*self.source_columns(), "(intercept)"], [*self.feature_names, "(intercept)"],
                [*self.coefficients, 0.0]))]
        table = df.sparkSession.createDataFrame(names, "i int, feature string, transformed_feature string, aw double")
        return table.join(sums, "i", "left").select(
            "feature", "transformed_feature", ((F.col("s") - F.col("aw")) / F.col("n")).alias("gradient"))

    def save(self, path: str) -> None:
        """Model directory: the Spark ML pipeline plus the preprocessing statistics."""
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
        meta = {"numeric": self.prep.numeric, "categorical": self.prep.categorical, "medians": self.prep.medians,
                "modes": self.prep.modes, "means": self.prep.means, "scales": self.prep.scales,
                "feature_names": self.feature_names, "coefficients": [float(c) for c in self.coefficients],
                "intercept": float(self.intercept), "alpha": self.alpha, "n_train": self.n_train,
                "label_std": self.label_std, "category_labels": self.category_labels, "labels": self.prep.labels}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").json(
            f"{path}/meta")

    @staticmethod
    def load(path: str) -> RidgeModel:
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
        meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
        prep = Preprocessing(meta["numeric"], meta["categorical"], meta["medians"], meta["modes"], meta["means"],
                             meta["scales"], meta.get("labels", {}))
        return RidgeModel(prep, PipelineModel.load(f"{path}/pipeline"), meta["feature_names"], meta["coefficients"],
                          meta["intercept"], meta["alpha"], meta["n_train"], meta.get("label_std", 0.0),
                          meta.get("category_labels", {}))


def subset_preprocessing(prep: Preprocessing, numeric: Sequence[str], categorical: Sequence[str]) -> Preprocessing:
    """Statistics of a column subset: per-column statistics do not depend on
    the other columns, so ablation fits reuse one pass over the full set."""
    return Preprocessing(list(numeric), list(categorical), {c: prep.medians[c] for c in numeric},
                         {c: prep.modes[c] for c in categorical}, {c: prep.means[c] for c in numeric},
                         {c: prep.scales[c] for c in numeric}, {c: prep.labels[c] for c in categorical if c in prep.labels})


@dataclass
class Gram:
    """Sums of products of all transformed features, the target and 1 over the training
    rows: all that fits of any subset of the columns need."""

    prep: Preprocessing
    products: np.ndarray
    features: list[tuple[str, str, str | None]]      # (name, source column, category)

    @property
    def n(self) -> int:
        return int(round(self.products[-1, -1]))

    @property
    def label_std(self) -> float:
        n, sums = self.products[-1, -1], self.products[-2, -1]
        return float(np.sqrt(max(0.0, self.products[-2, -2] / n - (sums / n) ** 2))) if n else 0.0

    def solve(self, columns: Sequence[str] | None = None, alpha: float = 1.0) -> RidgeModel:
        """The ridge model of a subset of the input columns: ‖y − b − Xw‖² + α‖w‖² at its least."""
        chosen = set(self.prep.numeric + self.prep.categorical if columns is None else columns)
        at = [i for i, (_, source, _) in enumerate(self.features) if source in chosen]
        n = self.products[-1, -1]
        if not n:
            raise ValueError("no training rows with a target")
        sums, target_sum = self.products[at, -1], self.products[-2, -1]
        # centred products: the intercept isn't penalised
        inner = self.products[np.ix_(at, at)] - np.outer(sums, sums) / n
        outer = self.products[at, -2] - sums * target_sum / n
        if alpha > 0:
            weights = np.linalg.solve(inner + alpha * np.eye(len(at)), outer)
        else:
            weights = np.linalg.lstsq(inner, outer, rcond=None)[0]
        numeric = [c for c in self.prep.numeric if c in chosen]
        categorical = [c for c in self.prep.categorical if c in chosen]
        prep = subset_preprocessing(self.prep, numeric, categorical)
        labels = {c: self.prep.labels[c] for c in categorical}
        return RidgeModel(prep, feature_pipeline(prep), [self.features[i][0] for i in at], [float(w) for w in weights],
                          float((target_sum - sums @ weights) / n), alpha, self.n, self.label_std, labels)


#: Transformed features that a Gram matrix may have: k² doubles come to the driver.
MAX_FEATURES = 8192


def feature_pipeline(prep: Preprocessing) -> PipelineModel:
    """Category indices, one-hot columns and the vector ``__features`` of
    :meth:`Preprocessing.transform`'s rows. Columns without any value add no feature."""
    known = [c for c in prep.categorical if prep.labels[c]]
    # one single-column model per column: the multi-column constructor pads ragged label lists with NULLs
    stages = [StringIndexerModel.from_labels(list(prep.labels[c]), inputCol=c, outputCol=f"__idx_{c}", handleInvalid="keep")
              for c in known]
    if not known:
        return PipelineModel([VectorAssembler(inputCols=[f"__z_{c}" for c in prep.numeric], outputCol="__features", handleInvalid="keep")])
    from pyspark.sql import SparkSession
    sizes = PipelineModel(stages).transform(SparkSession.getActiveSession().createDataFrame([], ", ".join(f"`{c}` string" for c in known)))
    # sizes come from the indices' metadata: no pass over data
    one_hot = OneHotEncoder(inputCols=[f"__idx_{c}" for c in known], outputCols=[f"__oh_{c}" for c in known], dropLast=True).fit(sizes)
    assemble = VectorAssembler(inputCols=[f"__z_{c}" for c in prep.numeric] + [f"__oh_{c}" for c in known], outputCol="__features", handleInvalid="keep")
    return PipelineModel([*stages, one_hot, assemble])


#: Numbers in a block of rows that a task multiplies at once, and columns of a product at once.
BLOCK_NUMBERS, BLOCK_COLUMNS = 1 << 21, 512


def _sums_of_products(rows: DataFrame, prep: Preprocessing, target: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Over the filled-in numeric columns less their medians, the one-hot columns, the target
    and 1: the sums of products of the rows with a target; and the count, sums and sums of
    squares of the numeric columns of all rows. A task multiplies blocks of rows; the tasks'
    matrices are added up in a tree."""
    numeric, shift = len(prep.numeric), [prep.medians[c] for c in prep.numeric]
    labels = [prep.labels[c] for c in prep.categorical]
    filled = prep.imputed(rows.withColumn("__y", F.col(target).cast("double")))
    columns = [(F.col(c) - F.lit(m)).alias(f"n{i}") for i, (c, m) in enumerate(zip(prep.numeric, shift))]
    columns += [F.col(c).alias(f"c{i}") for i, c in enumerate(prep.categorical)]
    length = size * size + 3 * max(1, numeric)

    def blocks(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        sums = np.zeros(length)
        products, moments = sums[:size * size].reshape(size, size), sums[size * size:].reshape(3, -1)
        step = max(1, BLOCK_NUMBERS // size)
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                x = np.zeros((batch.num_rows, size))
                for i in range(numeric):
                    x[:, i] = batch.column(i)
                if numeric:
                    moments[0] += len(x)
                    moments[1] += x[:, :numeric].sum(axis=0)
                    moments[2] += np.square(x[:, :numeric]).sum(axis=0)
                start = numeric
                for i, values in enumerate(labels):
                    column = batch.column(numeric + i)
                    index = pc.index_in(column, value_set=pa.array(values, column.type))
                    known = np.flatnonzero(index.is_valid())
                    x[known, start + index.drop_null().to_numpy()] = 1.0
                    start += len(values)
                y = batch.column(batch.num_columns - 1)
                x[:, -2], x[:, -1] = y.fill_null(0.0), 1.0
                x = x[np.asarray(y.is_valid())]
                for j in range(0, size, BLOCK_COLUMNS):
                    products[j:j + BLOCK_COLUMNS] += x[:, j:j + BLOCK_COLUMNS].T @ x
        yield pa.record_batch([pa.array([sums.tobytes()], pa.binary())], names=["sums"])

    parts = filled.select(*columns, "__y").mapInArrow(blocks, "sums binary").rdd
    sums = parts.treeAggregate(np.zeros(length), lambda a, r: a + np.frombuffer(r["sums"]), np.add)
    return sums[:size * size].reshape(size, size), sums[size * size:].reshape(3, -1)


def fit_gram(train: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str],
             accuracy: int | None = None, prep: Preprocessing | None = None) -> Gram:
    """The Gram matrix of the rows with a target, in one pass after the statistics of imputation
    (G1, G2). The same pass sums up what means and scales need (of all rows, G3): products of
    numbers less their medians, which lie within a standard deviation of the means, are brought
    to the standardised columns afterwards."""
    given = prep is not None
    prep = subset_preprocessing(prep, numeric, categorical) if given else _fit_filling(train, numeric, categorical, accuracy)
    features = [(c, c, None) for c in prep.numeric]
    features += [(f"{c}={v}", c, v) for c in prep.categorical for v in prep.labels[c]]
    if len(features) > MAX_FEATURES:
        raise ValueError(f"{len(features)} transformed features; at most {MAX_FEATURES}: collapse rare categories first")
    size = len(features) + 2
    products, moments = _sums_of_products(train.where(F.col(target).isNotNull()) if given else train, prep, target, size)
    if not given:
        for i, c in enumerate(prep.numeric):
            n = moments[0, i] or 1.0
            mean, square = moments[1, i] / n, moments[2, i] / n
            prep.means[c] = float(prep.medians[c] + mean)
            # zero variance → scale 1 (the standardised column is then all zeros)
            prep.scales[c] = float(np.sqrt(np.maximum(square - mean * mean, 0.0))) or 1.0
    to = np.eye(size)
    for i, c in enumerate(prep.numeric):
        to[i, i], to[-1, i] = 1.0 / prep.scales[c], (prep.medians[c] - prep.means[c]) / prep.scales[c]
    return Gram(prep, to.T @ products @ to, features)


def fit_ridge(train: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str],
              alpha: float = 1.0, accuracy: int | None = None, prep: Preprocessing | None = None) -> RidgeModel:
    """Fit imputation + scaling + one-hot + ridge on ``train``."""
    return fit_gram(train, target, numeric, categorical, accuracy, prep).solve(alpha=alpha)


def top_coefficients(model: RidgeModel, spark, k: int = 25) -> DataFrame:
    """k largest and k smallest coefficients with names."""
    cf = model.coefficient_frame(spark)
    head = cf.orderBy(F.desc("coef"), F.asc("feature")).limit(k).withColumn("side", F.lit("largest"))
    tail = cf.orderBy(F.asc("coef"), F.asc("feature")).limit(k).withColumn("side", F.lit("smallest"))
    return head.unionByName(tail)
