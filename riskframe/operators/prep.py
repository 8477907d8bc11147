"""Fitted preprocessing as Spark ML stages built from exact statistics.

Numeric columns: median imputation and robust scaling. Coded columns: most frequent value for
gaps and one-hot encoding without the smallest category. Fitting is a handful of aggregates,
applying is a projection. Both stages take part in ``Pipeline`` and save with it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.config import CATEGORICAL_FEATURES, NUMERIC_FEATURES, FeatureConfig
from riskframe.functions.bounded import SMALL_ROWS, reused
from riskframe.functions.columns import add_all, array, double, names_of, num, q, struct, to_long_form, with_expressions
from riskframe.functions.quantiles import exact_quantiles
from riskframe.operators.clean import fill_missing_with_zero
from riskframe.operators.codes import indicator_vector
from riskframe.operators.features import engineered_names, with_engineered_features


#: Codes of a column beyond which they are joined as a table instead of written into the plan; results are the same.
WIDE = 200


class RepaymentFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the engineered features; gaps and infinities left over become 0 on request."""

    ratios = Param(Params._dummy(), "ratios", "build the ratio features", TypeConverters.toBoolean)
    payments = Param(Params._dummy(), "payments", "build the payment features", TypeConverters.toBoolean)
    balances = Param(Params._dummy(), "balances", "build the balance features", TypeConverters.toBoolean)
    missing = Param(Params._dummy(), "missing", "zero or impute", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, ratios=True, payments=True, balances=True, missing="zero"):
        super().__init__()
        self._setDefault(ratios=True, payments=True, balances=True, missing="zero")
        self._set(**self._input_kwargs)

    def config(self) -> FeatureConfig:
        return FeatureConfig(self.getOrDefault("ratios"), self.getOrDefault("payments"),
                             self.getOrDefault("balances"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        config = self.config()
        out = with_engineered_features(dataset, config)
        if self.getOrDefault("missing") != "zero":
            return out
        return fill_missing_with_zero(
            out, [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES, *engineered_names(config)])


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for the present values: partial counts before a tiny shuffle."""
    long = to_long_form(df, columns)
    return long.where("value IS NOT NULL").groupBy("column", "value").agg(F.count("*").alias("n"))


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    with reused(df.select(*names_of(columns))) as table:
        return {c: q[0] for c, q in exact_quantiles(table, columns, [0.5]).items()}


def fit_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per column; the smallest one wins a tie."""
    best = F.expr("min_by(value, struct(-n, value)) AS mode")
    return category_counts(df, columns).groupBy("column").agg(best)


def _plain(value: float) -> float | int:
    return int(value) if float(value).is_integer() else float(value)


class AccountPrep(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    numericCols = Param(Params._dummy(), "numericCols", "columns to scale", TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "columns to encode", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "feature vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, outputCol="features"):
        super().__init__()
        self._setDefault(numericCols=[*NUMERIC_FEATURES, *engineered_names()],
                         categoricalCols=list(CATEGORICAL_FEATURES), outputCol="features")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "AccountPrepModel":
        numeric = self.getOrDefault("numericCols")
        coded = self.getOrDefault("categoricalCols")
        with reused(dataset.select(*names_of(dict.fromkeys([*numeric, *coded])))) as df:
            statistics = fit_statistics(df, numeric, coded)
        return AccountPrepModel(statistics=statistics, outputCol=self.getOrDefault("outputCol"))


def fit_statistics(df: DataFrame, numeric: Sequence[str], coded: Sequence[str]) -> dict:
    """{"numeric": {c: {fill, center, scale}}, "coded": {c: {fill, categories}}}.

    Quartiles are taken after median imputation, as scaling follows imputing. The categories become part of the model,
    one feature each, so they come to the driver as the model does.
    """
    quartiles = exact_quantiles(df, numeric, [0.25, 0.5, 0.75])
    medians = {c: quartiles[c][1] for c in numeric}
    gaps = df.agg(*[F.expr(f"count_if({q(c)} IS NULL)") for c in numeric]).first() if numeric else ()
    holed = [c for i, c in enumerate(numeric) if gaps[i] and medians[c] is not None]
    if holed:
        filled = df.selectExpr(*[f"coalesce({double(c)}, {num(medians[c])}) AS {q(c)}" for c in holed])
        quartiles.update(exact_quantiles(filled, holed, [0.25, 0.5, 0.75]))
    scaling = {}
    for c in numeric:
        q25, q50, q75 = quartiles[c]
        if q50 is None:
            raise ValueError(f"column {c} has no present value to fit on")
        scaling[c] = {"fill": medians[c], "center": q50, "scale": (q75 - q25) or 1.0}
    rows = category_counts(df, coded).collect() if coded else []
    encoding = {}
    for c in coded:
        seen = sorted((r for r in rows if r["column"] == c), key=lambda r: r["value"])
        if not seen:
            raise ValueError(f"column {c} has no present value to fit on")
        mode = min(seen, key=lambda r: (-r["n"], r["value"]))["value"]
        encoding[c] = {"fill": _plain(mode), "categories": [_plain(r["value"]) for r in seen]}
    return {"numeric": scaling, "coded": encoding}


class AccountPrepModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    statistics = Param(Params._dummy(), "statistics", "fitted statistics")
    outputCol = Param(Params._dummy(), "outputCol", "feature vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, statistics=None, outputCol="features"):
        super().__init__()
        self._setDefault(outputCol="features")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def fitted(self) -> dict:
        return self.getOrDefault("statistics")

    def feature_names(self) -> list[str]:
        encoded = [f"{c}_{v}" for c, e in self.fitted()["coded"].items() for v in e["categories"][1:]]
        return [*self.fitted()["numeric"], *encoded]

    def _filled(self, column: str, fill: float) -> str:
        return f"coalesce({double(column)}, {num(float(fill))})"

    def expressions(self) -> dict[str, str]:
        """One scaled or indicator expression per feature name."""
        indicators = {
            f"{c}_{v}": f"CAST({self._filled(c, e['fill'])} = {num(float(v))} AS DOUBLE)"
            for c, e in self.fitted()["coded"].items() for v in e["categories"][1:]}
        return {**self._scaled(), **indicators}

    def _scaled(self) -> dict[str, str]:
        return {
            c: f"(({self._filled(c, s['fill'])} - {num(float(s['center']))}) / {num(float(s['scale']))})"
            for c, s in self.fitted()["numeric"].items()}

    def logit(self, intercept: float, coefficients: Sequence[float], complete: bool = False,
              integral: Sequence[str] = (), looked_up: Mapping[str, str] | None = None) -> str:
        """Linear predictor of a model on the encoded features, straight from the input columns.

        Scaling folds into the weights and each coded column is one CASE over its categories,
        so scoring needs no feature vector; features without weight disappear. ``complete``
        promises inputs without gaps, ``integral`` names whole-number columns, whose categories
        compare faster, ``looked_up`` gives the weights of columns that ``with_weights`` joined.
        """
        filled = (lambda c, fill: double(c)) if complete else self._filled
        weights = dict(zip(self.feature_names(), map(float, coefficients)))
        constant, terms = float(intercept), []
        for c, s in self.fitted()["numeric"].items():
            if weights[c]:
                slope = weights[c] / float(s["scale"])
                constant -= slope * float(s["center"])
                terms.append(f"{filled(c, s['fill'])} * {num(slope)}")
        for c, e in self.fitted()["coded"].items():
            if looked_up and c in looked_up:
                terms.append(looked_up[c])
                continue
            whole = c in integral and all(isinstance(v, int) for v in (e["fill"], *e["categories"]))
            if len(e["categories"]) > WIDE:  # a lookup in place of a branch for each category
                keys = array([num(float(v)) for v in e["categories"][1:]])
                found = array([num(weights[f"{c}_{v}"]) for v in e["categories"][1:]])
                terms.append(f"coalesce(try_element_at(map_from_arrays({keys}, {found}), {filled(c, e['fill'])}), 0D)")
                continue
            cases = [f"WHEN {num(v if whole else float(v))} THEN {num(weights[f'{c}_{v}'])}"
                     for v in e["categories"][1:] if weights[f"{c}_{v}"]]
            code = filled(c, e["fill"])
            if whole:
                code = q(c) if complete else f"coalesce({q(c)}, {num(e['fill'])})"
            if cases:
                terms.append(f"CASE {code} {' '.join(cases)} ELSE 0D END")
        return add_all([num(constant), *terms])

    def wide(self) -> list[str]:
        """Coded columns with more codes than a branch or a list of literals should have."""
        return [c for c, e in self.fitted()["coded"].items() if len(e["categories"]) > WIDE]

    def _looked_up(self, df: DataFrame, column: str, values: Sequence[float], name: str) -> DataFrame:
        """A value for each code of a column but the smallest, joined by the code: no literals, and broadcast if the codes are few."""
        e = self.fitted()["coded"][column]
        known = f"{name}_code"
        table = pa.table({known: pa.array(map(float, e["categories"][1:]), pa.float64()), name: pa.array(values)})
        lookup = df.sparkSession.createDataFrame(table)
        lookup = F.broadcast(lookup) if table.num_rows <= SMALL_ROWS else lookup
        return df.join(lookup, F.expr(self._filled(column, e["fill"])) == F.col(q(known)), "left").drop(known)

    def with_weights(self, df: DataFrame, coefficients: Sequence[float]) -> tuple[DataFrame, dict[str, str]]:
        """The rows with the weight of each wide column's code, and the expressions of these weights for ``logit``."""
        weights, found = dict(zip(self.feature_names(), map(float, coefficients))), {}
        for i, c in enumerate(self.wide()):
            df = self._looked_up(df, c, [weights[f"{c}_{v}"] for v in self.fitted()["coded"][c]["categories"][1:]], f"__weight_{i}")
            found[c] = f"coalesce(__weight_{i}, 0D)"
        return df, found

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """All input columns plus the vector, sparse where that is smaller; its metadata carry the feature names.

        A code becomes its position, by a short list of literals or, for a wide column, by a join; positions become indicators.
        """
        output, coded = self.getOrDefault("outputCol"), self.fitted()["coded"]
        placed = dataset
        for i, c in enumerate(self.wide()):
            placed = self._looked_up(placed, c, range(1, len(coded[c]["categories"])), f"__place_{c}")
        positions = []
        for c, e in coded.items():
            if len(e["categories"]) < 2:
                continue
            listed = array([num(float(v)) for v in e["categories"][1:]])
            place = q(f"__place_{c}") if c in self.wide() else f"array_position({listed}, {self._filled(c, e['fill'])})"
            positions.append(f"{place} AS {q(f'__position_{c}')}")
        scaled = list(self._scaled().values())
        ready = placed.select(*names_of(dataset.columns), *map(F.expr, positions),
                              *([array_to_vector(F.expr(array(scaled))).alias("__scaled")] if scaled else []))
        sizes = {f"__position_{c}": len(e["categories"]) for c, e in coded.items() if len(e["categories"]) > 1}
        names = self.feature_names()
        metadata = {"ml_attr": {"attrs": {"numeric": [{"idx": i, "name": n} for i, n in enumerate(names)]},
                                "num_attrs": len(names)}}
        made = indicator_vector(ready, sizes, "__features", ("__scaled", len(scaled)) if scaled else None)
        return made.select(*names_of(dataset.columns), F.col("__features").alias(output, metadata=metadata))


def standard_scaled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population deviation; a constant column is only centred."""
    row = df.agg(*[F.expr(struct(m=f"avg({q(c)})", s=f"stddev_pop({q(c)})")) for c in columns]).first()
    return with_expressions(df, {
        c: f"({double(c)} - {num(row[i].m)}) / {num(row[i].s or 1.0)}"
        for i, c in enumerate(columns) if row[i].m is not None})
