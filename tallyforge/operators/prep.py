"""Imputation, scaling and encoding, fitted on the training split only.

Fitting gathers a few numbers per column; the transform is then one narrow projection with
those numbers as literals (only nearest-neighbour imputation looks at donors again).
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.columns import is_finite, is_missing, quoted
from tallyforge.operators.knn import knn_impute
from tallyforge.operators.ranks import exact_quantiles, numbered
from tallyforge.session import scratch_path

IMPUTERS = ("simple", "knn")
STRATEGIES = ("mean", "median", "most_frequent", "constant")
SCALERS = ("robust", "standard", "minmax", "none")
#: Categories that may become a column each; more of them are encoded by a joined table.
MAX_COLUMNS = 10_000


def _known(df: DataFrame, name: str) -> Column:
    return F.when(~is_missing(df, name), F.col(quoted(name)))


def most_frequent(df: DataFrame, columns: Sequence[str]) -> dict[str, Any]:
    """Most frequent known value per column, the smallest on a tie; one small grouped job per column type."""
    out = {}
    for c in columns:
        row = (df.groupBy(_known(df, c).alias("v")).agg(F.count(F.lit(1)).alias("n")).where(F.col("v").isNotNull())
               .agg(F.min(F.struct((-F.col("n")).alias("neg"), "v")).alias("best")).first())
        out[c] = row["best"]["v"] if row["best"] is not None else None
    return out


def fit_imputer(df: DataFrame, columns: Sequence[str], strategy: str, fill_value: Any = None) -> dict[str, Any]:
    if strategy not in STRATEGIES:
        raise ValueError(f"unsupported imputation strategy {strategy!r}")
    if strategy == "constant":
        return {c: fill_value for c in columns}
    if strategy == "most_frequent":
        fills = most_frequent(df, columns)
    elif strategy == "mean":
        row = df.agg(*[F.avg(_known(df, c)).alias(c) for c in columns]).first()
        fills = {c: row[c] for c in columns}
    else:
        medians = exact_quantiles(df, list(columns), [0.5])
        fills = {c: medians[c][0.5] for c in columns}
    empty = [c for c in columns if fills[c] is None]
    if empty:
        raise ValueError(f"no known value to impute from in {empty}")
    return fills


def fit_median_robust(df: DataFrame, columns: Sequence[str], options: Mapping[str, Any] | None = None
                      ) -> tuple[dict[str, Any], dict[str, tuple[float, float]]]:
    """What `fit_imputer` by medians and a robust `fit_scaler` of the filled rows say, from one search for quantiles.

    Only columns with missing values, whose quantiles move when they are filled, are searched again.
    """
    options, columns = options or {}, list(columns)
    found = exact_quantiles(df, columns, sorted({*quantile_range(options), 0.5}))
    fills = {c: found[c][0.5] for c in columns}
    empty = [c for c in columns if fills[c] is None]
    if empty:
        raise ValueError(f"no known value to impute from in {empty}")
    gaps = df.agg(*[F.count_if(is_missing(df, c)).alias(str(i)) for i, c in enumerate(columns)]).first()
    gappy = [c for i, c in enumerate(columns) if gaps[str(i)]]
    again = fit_scaler(fill(df, fills), gappy, "robust", options)
    whole = fit_scaler(df, [c for c in columns if c not in gappy], "robust", options, found)
    return fills, {c: (again if c in gappy else whole)[c] for c in columns}


def fill(df: DataFrame, fills: Mapping[str, Any]) -> DataFrame:
    return df.withColumns({c: F.coalesce(_known(df, c), F.lit(v)) for c, v in fills.items()})


def quantile_range(options: Mapping[str, Any]) -> tuple[float, float]:
    low, high = options.get("quantile_range", (25.0, 75.0))
    return low / 100.0, high / 100.0


def fit_scaler(df: DataFrame, columns: Sequence[str], kind: str, options: Mapping[str, Any] | None = None,
               known: Mapping[str, Mapping[float, float]] | None = None) -> dict[str, tuple[float, float]]:
    """(shift, factor) per column: scaled = (x - shift) * factor. `known` may hold the quantiles that a robust scaler needs."""
    options, columns = options or {}, list(columns)
    if kind not in SCALERS:
        raise ValueError(f"unsupported scaler {kind!r}")
    if kind == "none" or not columns:
        return {c: (0.0, 1.0) for c in columns}
    if kind == "robust":
        low, high = quantile_range(options)
        qs = exact_quantiles(df, columns, sorted({low, 0.5, high})) if known is None else known
        center = {c: qs[c][0.5] if options.get("with_centering", True) else 0.0 for c in columns}
        width = {c: qs[c][high] - qs[c][low] if options.get("with_scaling", True) else 1.0 for c in columns}
        return {c: (center[c], 1.0 / (width[c] or 1.0)) for c in columns}
    stats = {"standard": (F.avg, F.stddev_pop), "minmax": (F.min, F.max)}[kind]
    row = df.agg(*[f(_known(df, c).cast("double")).alias(f"{j}_{i}") for i, c in enumerate(columns)
                   for j, f in enumerate(stats)]).first()
    if kind == "standard":
        return {c: (row[f"0_{i}"] if options.get("with_mean", True) else 0.0,
                    1.0 / (row[f"1_{i}"] or 1.0) if options.get("with_std", True) else 1.0)
                for i, c in enumerate(columns)}
    lo, hi = options.get("feature_range", (0.0, 1.0))
    out = {}
    for i, c in enumerate(columns):
        factor = (hi - lo) / ((row[f"1_{i}"] - row[f"0_{i}"]) or 1.0)
        out[c] = (row[f"0_{i}"] - lo / factor if factor else row[f"0_{i}"], factor)
    return out


def scale(df: DataFrame, scaler: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(quoted(c)).cast("double") - F.lit(float(m))) * F.lit(float(f))
                           for c, (m, f) in scaler.items()})


def fit_categories(df: DataFrame, columns: Sequence[str], max_columns: int = MAX_COLUMNS) -> tuple[dict[str, list[str]], dict[str, DataFrame]]:
    """Sorted distinct values of each column with up to `max_columns` of them, and a category table for each other one."""
    columns = list(columns)
    if not columns:
        return {}, {}
    sizes = df.agg(*[F.count_distinct(F.col(quoted(c)).cast("string")).alias(c) for c in columns]).first()
    wide = [c for c in columns if sizes[c] > max_columns]
    narrow = [c for c in columns if c not in wide]
    row = df.agg(*[F.sort_array(F.collect_set(F.col(quoted(c)).cast("string"))).alias(c) for c in narrow]).first() if narrow else {}
    return {c: list(row[c]) for c in narrow}, {c: category_table(df, c) for c in wide}


def _unknown(name: str, categories: list[str], otherwise: Column) -> Column:
    col = F.col(quoted(name)).cast("string")
    seen = F.coalesce(col.isin(categories), F.lit(False))
    return F.when(seen, otherwise).otherwise(
        F.raise_error(F.concat(F.lit(f"unknown category in {name}: "), F.coalesce(col, F.lit("null")))).cast("double"))


def onehot_columns(name: str, categories: list[str], handle_unknown: str = "error", drop: str | None = None) -> list[Column]:
    if handle_unknown not in ("error", "ignore"):
        raise ValueError(f"unsupported handle_unknown {handle_unknown!r}")
    kept = categories[1:] if drop == "first" or (drop == "if_binary" and len(categories) == 2) else categories
    hits = [F.when(F.col(quoted(name)).cast("string") == v, 1.0).otherwise(0.0) for v in kept]
    if handle_unknown == "error" and hits:
        # All columns are computed together, so one of them checks for all.
        hits[0] = _unknown(name, categories, hits[0])
    return [hit.alias(f"{name}_{v}") for hit, v in zip(hits, kept)]


def ordinal_column(name: str, categories: list[str], handle_unknown: str = "error", unknown_value: float = -1) -> Column:
    col = F.col(quoted(name)).cast("string")
    place = F.array_position(F.array(*[F.lit(v) for v in categories]), col) - 1
    code = F.when(place >= 0, place.cast("double"))
    if handle_unknown == "use_encoded_value":
        return F.coalesce(code, F.lit(float(unknown_value))).alias(name)
    if handle_unknown != "error":
        raise ValueError(f"unsupported handle_unknown {handle_unknown!r}")
    return _unknown(name, categories, code).alias(name)


def category_table(df: DataFrame, column: str) -> DataFrame:
    """(category, place): the distinct known values of a column as text, numbered from 0 in text order, however many there are."""
    values = df.where(~is_missing(df, column)).select(F.col(quoted(column)).cast("string").alias("category")).distinct()
    return numbered(values, [F.col("category").asc()], "place")


def ordinal_by_table(df: DataFrame, column: str, categories: DataFrame, handle_unknown: str = "error", unknown_value: float = -1) -> DataFrame:
    """The column replaced by the place of its value as a double; values join the table, which Spark broadcasts if it is small."""
    if handle_unknown not in ("error", "use_encoded_value"):
        raise ValueError(f"unsupported handle_unknown {handle_unknown!r}")
    text = F.col(quoted(column)).cast("string")
    joined = df.join(categories, text == F.col("category"), "left")
    missing = F.lit(float(unknown_value)) if handle_unknown == "use_encoded_value" else F.raise_error(
        F.concat(F.lit(f"unknown category in {column}: "), F.coalesce(text, F.lit("null")))).cast("double")
    return joined.withColumn(column, F.coalesce(F.col("place").cast("double"), missing)).drop("category", "place")


def onehot_by_table(df: DataFrame, column: str, categories: DataFrame, output: str, handle_unknown: str = "error", drop: str | None = None,
                    size: int | None = None) -> DataFrame:
    """Adds a sparse vector with a one at the place of the value; unknown values give an empty vector or an error.

    `drop` leaves out the first value, always ("first") or if there are two ("if_binary"), as `onehot_columns` does. `size` is the
    length of the table, counted if it is not known.
    """
    if handle_unknown not in ("error", "ignore"):
        raise ValueError(f"unsupported handle_unknown {handle_unknown!r}")
    size = categories.count() if size is None else size
    placed = ordinal_by_table(df.withColumn("__kept", F.col(quoted(column))), column, categories,
                              "error" if handle_unknown == "error" else "use_encoded_value", size)
    code = F.col(quoted(column))
    if drop == "first" or (drop == "if_binary" and size == 2):
        # The first value goes to the place behind the last one, where unknown values are.
        size, code = size - 1, F.when((code == 0) | (code == size), float(size - 1)).otherwise(code - 1)
    coded = placed.withColumn(output, code).withColumn(column, F.col("__kept")).drop("__kept")
    # Places are 0 to size - 1; the place after the last one, dropped by the encoder, stands for unknown values.
    sizes = df.sparkSession.range(size + 1).select(F.col("id").cast("double").alias(output))
    encoder = OneHotEncoder(inputCol=output, outputCol="__hot", dropLast=True).fit(sizes)
    return encoder.transform(coded).drop(output).withColumnRenamed("__hot", output)


class _PrepParams(Params):
    numerical = Param(Params._dummy(), "numerical", "numeric feature columns", TypeConverters.toListString)
    categorical = Param(Params._dummy(), "categorical", "category feature columns", TypeConverters.toListString)
    config = Param(Params._dummy(), "config", "imputers, scaler and encoder as JSON text", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)

    def conf(self) -> dict[str, Any]:
        return json.loads(self.getOrDefault("config"))


class TabularPreprocessor(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Impute, scale and encode columns into a feature vector; fit it on the training split.

    config: {"numerical": {"imputer": {"type", "strategy", "fill_value", "n_neighbors", "weights", "donor_key"},
                           "scaler": {"type", ...options}},
             "categorical": {"imputer": {"strategy", "fill_value"},
                             "encoder": {"type", "handle_unknown", "unknown_value", "drop", "max_columns"}}}

    A category column with more than `max_columns` values is kept as a table of its values, saved beside the model and joined by
    `transform`; its one-hot block is a sparse vector.
    """

    @keyword_only
    def __init__(self, *, numerical=None, categorical=None, config="{}", outputCol="features"):
        super().__init__()
        self._setDefault(numerical=[], categorical=[], config="{}", outputCol="features")
        given = {k: v for k, v in self._input_kwargs.items() if v is not None}
        if isinstance(given.get("config"), Mapping):
            given["config"] = json.dumps(given["config"])
        self._set(**given)

    def _fit(self, dataset: DataFrame) -> "TabularPreprocessorModel":
        conf = self.conf()
        num, cat = list(self.getOrDefault("numerical")), list(self.getOrDefault("categorical"))
        num_conf, cat_conf = conf.get("numerical", {}), conf.get("categorical", {})
        imputer = num_conf.get("imputer", {})
        kind = imputer.get("type", "simple").lower()
        if kind not in IMPUTERS:
            raise ValueError(f"unsupported numeric imputer {kind!r}")
        if cat_conf.get("imputer", {}).get("type", "simple").lower() != "simple":
            raise ValueError("categories support only the simple imputer")
        encoder = cat_conf.get("encoder", {}).get("type", "onehot").lower()
        if encoder not in ("onehot", "ordinal"):
            raise ValueError(f"unsupported encoder {encoder!r}")
        state: dict[str, Any] = {"fills": {}, "knn": None}
        train = dataset
        if kind == "knn" and num:
            state["knn"] = {"k": imputer.get("n_neighbors", 5), "weights": imputer.get("weights", "uniform"),
                            "key": imputer["donor_key"]}
            # Written once: the scaler's passes would each search again.
            path = scratch_path(dataset.sparkSession, "imputed")
            knn_impute(train, dataset, num, state["knn"]["key"], state["knn"]["k"], state["knn"]["weights"]).select(*num).write.parquet(path)
            train = dataset.sparkSession.read.parquet(path)
        scaler = dict(num_conf.get("scaler", {}))
        scaling, strategy = scaler.pop("type", "robust").lower(), imputer.get("strategy", "median")
        if kind == "simple" and num and (strategy, scaling) == ("median", "robust"):
            state["fills"], state["scaler"] = fit_median_robust(dataset, num, scaler)
        else:
            if kind == "simple" and num:
                state["fills"] = fit_imputer(dataset, num, strategy, imputer.get("fill_value", 0.0))
                train = fill(dataset, state["fills"])
            state["scaler"] = fit_scaler(train, num, scaling, scaler)
        cat_imputer = cat_conf.get("imputer", {})
        state["cat_fills"] = fit_imputer(dataset, cat, cat_imputer.get("strategy", "most_frequent"),
                                         cat_imputer.get("fill_value", "missing_value")) if cat else {}
        most = cat_conf.get("encoder", {}).get("max_columns", MAX_COLUMNS)
        state["categories"], tables = fit_categories(fill(dataset, state["cat_fills"]), cat, most)
        state["wide"] = {c: table.count() for c, table in tables.items()}
        model = TabularPreprocessorModel()
        model.tables = tables
        model._set(numerical=num, categorical=cat, config=self.getOrDefault("config"),
                   outputCol=self.getOrDefault("outputCol"), state=json.dumps(state))
        model.donors = dataset.select(state["knn"]["key"], *num) if state["knn"] else None
        return model


class _ModelWriter(DefaultParamsWriter):
    """Parameters as JSON; the donors of nearest-neighbour imputation and the tables of wide categories beside them as parquet."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        if self.instance.donors is not None:
            self.instance.donors.write.parquet(f"{path}/donors")
        for i, column in enumerate(self.instance.fitted().get("wide", {})):
            self.instance.tables[column].write.parquet(f"{path}/categories-{i}")


class _ModelReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        if model.fitted()["knn"]:
            model.donors = self.sparkSession.read.parquet(f"{path}/donors")
        model.tables = {column: self.sparkSession.read.parquet(f"{path}/categories-{i}")
                        for i, column in enumerate(model.fitted().get("wide", {}))}
        return model


class TabularPreprocessorModel(Model, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted preprocessor. What it knows is JSON text in `state`, and the donors of nearest-neighbour imputation."""

    state = Param(Params._dummy(), "state", "fitted values as JSON text", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(numerical=[], categorical=[], config="{}", outputCol="features")
        self.donors: DataFrame | None = None
        self.tables: dict[str, DataFrame] = {}

    def write(self) -> _ModelWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> _ModelReader:
        return _ModelReader(cls)

    def fitted(self) -> dict[str, Any]:
        return json.loads(self.getOrDefault("state"))

    def _columns(self) -> list[Column]:
        """Numeric block, then category block, named after their block."""
        state, enc = self.fitted(), self.conf().get("categorical", {}).get("encoder", {})
        cols = []
        for c in self.getOrDefault("numerical"):
            shift, factor = state["scaler"][c]
            cols.append(((F.col(quoted(c)).cast("double") - F.lit(float(shift))) * F.lit(float(factor))).alias(f"numerical__{c}"))
        for c in self.getOrDefault("categorical"):
            if c in state.get("wide", {}):
                cols.append(F.col(quoted(f"__wide_{c}")).alias(f"categorical__{c}"))
                continue
            cats = state["categories"][c]
            if enc.get("type", "onehot").lower() == "onehot":
                cols += [x.alias(f"categorical__{n}") for x, n in zip(
                    onehot_columns(c, cats, enc.get("handle_unknown", "error"), enc.get("drop")), self._onehot_names(c, cats, enc))]
            else:
                cols.append(ordinal_column(c, cats, enc.get("handle_unknown", "error"), enc.get("unknown_value", -1))
                            .alias(f"categorical__{c}"))
        return cols

    @staticmethod
    def _onehot_names(name, categories, enc):
        drop = enc.get("drop")
        kept = categories[1:] if drop == "first" or (drop == "if_binary" and len(categories) == 2) else categories
        return [f"{name}_{v}" for v in kept]

    def feature_names(self) -> list[str]:
        """Names of the columns of `flat`; a wide one-hot block is one vector column."""
        state, enc = self.fitted(), self.conf().get("categorical", {}).get("encoder", {})
        names = [f"numerical__{c}" for c in self.getOrDefault("numerical")]
        for c in self.getOrDefault("categorical"):
            if c in state.get("wide", {}):
                names.append(f"categorical__{c}")
                continue
            onehot = enc.get("type", "onehot").lower() == "onehot"
            names += [f"categorical__{n}" for n in (self._onehot_names(c, state["categories"][c], enc) if onehot else [c])]
        return names

    def _imputed(self, dataset: DataFrame) -> DataFrame:
        state = self.fitted()
        if state["knn"]:
            if self.donors is None:
                raise ValueError("set `donors` before transforming with nearest neighbours")
            dataset = knn_impute(dataset, self.donors, self.getOrDefault("numerical"), state["knn"]["key"],
                                 state["knn"]["k"], state["knn"]["weights"])
        out = fill(dataset, {**state["fills"], **state["cat_fills"]})
        enc = self.conf().get("categorical", {}).get("encoder", {})
        for c, size in state.get("wide", {}).items():
            kept, strict = f"__wide_{c}", enc.get("handle_unknown", "error")
            if enc.get("type", "onehot").lower() == "onehot":
                out = onehot_by_table(out, c, self.tables[c], kept, strict, enc.get("drop"), size)
            else:
                out = ordinal_by_table(out.withColumn(kept, F.col(quoted(c))), kept, self.tables[c], strict, enc.get("unknown_value", -1))
        return out

    def flat(self, dataset: DataFrame, key: Sequence[str] = (), target: str | None = None) -> DataFrame:
        """Key, feature columns and, last, the target; everything else is dropped."""
        tail = [F.col(quoted(target)).cast("double").alias(target)] if target else []
        return self._imputed(dataset).select(*[F.col(quoted(c)) for c in key], *self._columns(), *tail)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out, output = self._imputed(dataset), self.getOrDefault("outputCol")
        columns, wide = self._columns(), self.fitted().get("wide", {})
        sparse = {f"categorical__{c}" for c in wide} if self.conf().get("categorical", {}).get("encoder", {}).get("type", "onehot").lower() == "onehot" else set()
        if not sparse:
            done = out.withColumn(output, array_to_vector(F.array(*columns)))
        else:
            # Dense stretches and sparse blocks in their order, put together by the assembler.
            blocks: list[tuple[str, list[Column]]] = []
            for name, column in zip(self.feature_names(), columns):
                if name in sparse or not blocks or blocks[-1][0]:
                    blocks.append((name if name in sparse else "", []))
                blocks[-1][1].append(column)
            parts = {f"__block{i}": own[0] if name else array_to_vector(F.array(*own)) for i, (name, own) in enumerate(blocks)}
            done = VectorAssembler(inputCols=list(parts), outputCol=output).transform(out.withColumns(parts)).drop(*parts)
        return done.drop(*[f"__wide_{c}" for c in wide])


# --- gates around features and target -----------------------------------------------------------------

def require_columns(df: DataFrame, features: Sequence[str], target: str, split: str = "split") -> DataFrame:
    """Rows and missing cells per split; a missing column, an empty table or a null target is an error."""
    missing = sorted({*features, target} - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    cells = F.lit(0)
    for c in [*features, target]:
        cells = cells + is_missing(df, c).cast("int")
    report = df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(cells).alias("missing_cells"),
        F.count_if(is_missing(df, target)).alias("missing_target"))
    return report


def check_features(report: DataFrame, splits: Sequence[str] = ("train", "val", "test")) -> None:
    rows = {r[0]: r for r in report.collect()}  # one row per split
    empty = [s for s in splits if s not in rows]
    if empty:
        raise ValueError(f"splits without rows: {empty}")
    bad = [s for s in splits if rows[s]["missing_target"]]
    if bad:
        raise ValueError(f"the target is missing in splits {bad}")


def finite_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, columns and cells that are null, NaN or infinite in a numeric matrix."""
    cells = F.lit(0)
    for c in columns:
        cells = cells + (~is_finite(F.col(quoted(c)))).cast("int")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(columns)).cast("long").alias("n_columns"),
                  F.coalesce(F.sum(cells), F.lit(0)).alias("bad_cells"))


def write_matrix(df: DataFrame, features: Sequence[str], target: str, path: str) -> None:
    """Feature columns with the target last."""
    df.select(*[F.col(quoted(c)).cast("double").alias(c) for c in [*features, target]]).write.mode("overwrite").parquet(path)


def read_matrix(spark, path: str) -> DataFrame:
    """Read a matrix back; fewer than two columns or a non-finite cell is an error."""
    df = spark.read.parquet(path)
    if len(df.columns) < 2:
        raise ValueError("a matrix needs features and a target")
    if finite_report(df, df.columns).first()["bad_cells"]:
        raise ValueError(f"non-finite values in {path}")
    return df
