"""Next-day forecast of a daily value: label, split, features, fit, scores, forecast row."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.dates import date_to_int
from seriesloom.operators import dense, evaluate, prepare, regress, series, split
from seriesloom.operators.relational import latest_row
from seriesloom.session import materialise

SEED = 346672
# Boosting: most rounds, and rounds without a better validation loss before it stops.
ROUNDS, PATIENCE = 50, 10
# Polynomial degree and scaling of each model of the forecast.
KINDS: dict[str, dict[str, Any]] = {
    "ols": {"degree": 1, "scaling": None, "fit": regress.fit_ols},
    "poly": {"degree": 2, "scaling": "zscore", "fit": regress.fit_ols},
    "lasso": {"degree": 3, "scaling": "minmax", "fit": regress.fit_lasso},
    "ridge": {"degree": 3, "scaling": "minmax", "fit": regress.fit_ridge},
}


@dataclass(frozen=True)
class Forecast:
    """What a run gives back."""

    model: Any
    predictions: DataFrame
    scores: DataFrame
    next_day: DataFrame


def add_date_feature(panel: DataFrame, date: str, name: str = "date_int") -> DataFrame:
    """The date as an int feature."""
    return panel.withColumn(name, date_to_int(F.col(date)))


def labelled_split(panel: DataFrame, series_col: str, date: str, value: str, seed: int = SEED, valid: bool = False) -> DataFrame:
    """Rows with their next-day label, a date feature and a seeded ``split``."""
    rows = add_date_feature(series.labelled_rows(panel, series_col, date, value), date)
    keyed = rows.withColumn("row_key", F.concat_ws("|", series_col, date))
    cut = split.three_way_split(keyed, "row_key", seed) if valid else split.exact_split(keyed, "row_key", seed)
    return cut.drop("row_key")


def feature_steps(train: DataFrame, columns: Sequence[str], degree: int, scaling: str | None) -> Callable[[DataFrame], DataFrame]:
    """Fits the feature preparation on ``train`` and gives a function that applies it anywhere.

    ``zscore`` scales before the expansion, which leaves least-squares predictions as they are but
    keeps powers of dates solvable; ``minmax`` scales the expanded terms.
    """
    steps: list[Callable[[DataFrame], DataFrame]] = []
    if scaling == "zscore":
        steps.append(prepare.fit_zscore(train, columns).transform)
    if degree == 1:
        names = list(columns)
    else:
        steps.append(lambda df: prepare.polynomial_columns(df, columns, degree)[0])
        names = prepare.polynomial_columns(train, columns, degree)[1]
    if scaling == "minmax":
        ready = train
        for step in steps:
            ready = step(ready)
        steps.append(prepare.fit_minmax(ready, names).transform)

    def apply(df: DataFrame) -> DataFrame:
        out = df
        for step in steps:
            out = step(out)
        return prepare.assemble(out, names).select(*[c for c in df.columns if c not in columns], "features")

    return apply


def run(panel: DataFrame, series_col: str, date: str, value: str, features: Sequence[str], kind: str = "ols", seed: int = SEED) -> Forecast:
    """One model of the forecast over all series.

    ``panel`` is read by the label, the fit, the scores and the forecast row: pass a stored or
    checkpointed table. The forecast row is each series' newest row under the next day's date.
    """
    setup = KINDS[kind]
    columns = [*features, "date_int"]
    rows = materialise(labelled_split(panel, series_col, date, value, seed))
    train = rows.where("split = 'train'")
    apply = feature_steps(train, columns, setup["degree"], setup["scaling"])
    model = setup["fit"](apply(train))
    predictions = model.transform(apply(rows)).drop("features")
    newest = add_date_feature(latest_row(panel, series_col, date), date)
    next_day = model.transform(apply(newest)).select(series_col, date, "prediction")
    return Forecast(model, predictions, evaluate.regression_scores(predictions), next_day)


def run_boosted(panel: DataFrame, series_col: str, date: str, value: str, features: Sequence[str], seed: int = SEED, max_iter: int = ROUNDS, patience: int = PATIENCE):
    """The three-way form with early stopping; gives the forecast and the training history."""
    columns = [*features, "date_int"]
    rows = materialise(labelled_split(panel, series_col, date, value, seed, valid=True))
    train = rows.where("split = 'train'")
    apply = feature_steps(train, columns, 1, "zscore")
    ready = materialise(apply(rows))
    model, history = regress.fit_boosted_mae(ready.where("split = 'train'"), ready.where("split = 'valid'"), max_iter=max_iter, patience=patience, seed=seed)
    predictions = model.transform(ready).drop("features")
    newest = add_date_feature(latest_row(panel, series_col, date), date)
    next_day = model.transform(apply(newest)).select(series_col, date, "prediction")
    return Forecast(model, predictions, evaluate.regression_scores(predictions), next_day), history


# Hidden layer sizes of the two dense regressors.
DENSE_LAYOUTS = ((100, 10, 10), (100, 10, 50, 10, 50, 10))


def run_dense(
    panel: DataFrame, series_col: str, date: str, value: str, features: Sequence[str], seed: int = SEED, layouts: Sequence[Sequence[int]] = DENSE_LAYOUTS, **options
) -> tuple[DataFrame, DataFrame]:
    """Dense regressors on absolute error in the three-way form, trained in the same passes.

    Gives rows, R2 and mean absolute error per layout and part, and the losses per layout and round in units
    of the label's deviation; ``layout`` counts from 1.
    """
    columns = [*features, "date_int"]
    rows = labelled_split(panel, series_col, date, value, seed, valid=True).withColumn("_own", F.col("label").cast("double"))
    rows = materialise(rows.withColumn("_scaled", F.col("_own")))
    ready = materialise(prepare.fit_zscore(rows.where("split = 'train'"), [*columns, "_scaled"]).transform(rows))
    centre, reach = rows.where("split = 'train'").agg(F.avg("_own"), F.stddev_pop("_own")).first()
    nets = [dense.new_net([len(columns), *hidden, 1], "relu", "absolute", seed) for hidden in layouts]
    fitted, histories = dense.fit_dense_nets(ready, columns, nets, label="_scaled", **options)
    scored = ready.select("split", F.col("_own").alias("label"), *columns)
    for number, net in enumerate(fitted, 1):
        scored = dense.predict_dense(scored, net, columns, f"_of_{number}").withColumn(f"_of_{number}", F.col(f"_of_{number}") * F.lit(reach) + F.lit(centre))
    every = F.explode(F.array(*[F.struct(F.lit(n).alias("layout"), F.col(f"_of_{n}").alias("prediction")) for n in range(1, len(fitted) + 1)])).alias("s")
    scores = evaluate.regression_scores(scored.select("split", "label", every).select("split", "label", "s.*"), ["layout", "split"])
    return scores, dense.history_table(panel.sparkSession, histories)
