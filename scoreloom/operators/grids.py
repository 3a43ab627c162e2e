"""Default hyper-parameter grids and fold numbers by training size."""

from __future__ import annotations

from itertools import product

# Upper row limit (None: any), grid. The first fitting entry counts.
DEFAULT_GRIDS = {
    "DL": [
        (10_000, {"hidden": [[30, 30], [20, 20], [10, 10]], "input_dropout_ratio": [0, 0.05, 0.1],
                  "l1": [0, 1e-4, 1e-6], "l2": [0, 1e-4, 1e-6]}),
        (100_000, {"hidden": [[20, 20], [30, 30]], "input_dropout_ratio": [0, 0.05],
                   "l1": [0, 1e-6], "l2": [0, 1e-6]}),
        (None, {"hidden": [[20, 20], [10, 10]], "input_dropout_ratio": [0, 0.05],
                "l1": [1e-6], "l2": [1e-6]}),
    ],
    "LR": [
        (10_000, {"alpha": [0, 0.25, 0.5, 0.75, 1], "lambda": [1, 0.5, 0.1, 0.01, 0]}),
        (100_000, {"alpha": [0, 0.5, 1], "lambda": [1, 0.5, 0.1, 0.01, 0]}),
        (None, {"alpha": [0, 0.5, 1], "lambda": [1, 0.5, 0.1, 0]}),
    ],
    "GBM": [
        (10_000, {"ntrees": [50, 70], "max_depth": [5, 7], "learn_rate": [0.1, 0.01],
                  "min_rows": [5, 10], "sample_rate": [1], "col_sample_rate_per_tree": [0.8],
                  "col_sample_rate": [1]}),
        (100_000, {"ntrees": [50], "max_depth": [5, 7], "learn_rate": [0.1], "min_rows": [5, 10],
                   "sample_rate": [1], "col_sample_rate_per_tree": [0.8], "col_sample_rate": [1]}),
        (None, {"ntrees": [50], "max_depth": [5, 7], "learn_rate": [0.1], "min_rows": [5, 10],
                "sample_rate": [0.8], "col_sample_rate_per_tree": [0.8], "col_sample_rate": [1]}),
    ],
    "NB": [
        (50_000, {"laplace": [0.1, 1, 5, 10], "min_sdev": [0.001, 0.005, 0.1],
                  "eps_sdev": [0, 0.001, 0.01]}),
        (500_000, {"laplace": [0.1, 1, 5], "min_sdev": [0.001, 0.1], "eps_sdev": [0, 0.01]}),
        (None, {"laplace": [0.1, 5], "min_sdev": [0.001, 0.005], "eps_sdev": [0, 0.01]}),
    ],
    "RF": [
        (10_000, {"ntrees": [50, 70], "max_depth": [5, 15], "sample_rate": [0.6, 0.8],
                  "min_rows": [5, 10], "col_sample_rate_per_tree": [1]}),
        (100_000, {"ntrees": [50, 70], "max_depth": [5, 10], "sample_rate": [0.6],
                   "min_rows": [5, 10], "col_sample_rate_per_tree": [1]}),
        (None, {"ntrees": [50], "max_depth": [5, 10], "sample_rate": [0.6], "min_rows": [5, 10],
                "col_sample_rate_per_tree": [1]}),
    ],
    "KM": [
        (10_000, {"k": [3, 5, 10], "max_iterations": [5, 10, 20], "standardize": [0.1, 0.6, 0.8]}),
        (100_000, {"k": [3, 5, 10], "max_iterations": [5, 10, 20], "standardize": [0.1, 0.6]}),
        (None, {"k": [3, 5, 10], "max_iterations": [5, 10], "standardize": [0.1, 0.6]}),
    ],
}

# Upper row limit (None: any), folds. Below two folds means a holdout.
DEFAULT_FOLDS = {
    "DL": [(100_000, 3), (500_000, 2), (None, 1)],
    "LR": [(5_000, 3), (10_000, 5), (100_000, 3), (None, 2)],
    "GBM": [(100_000, 3), (500_000, 2), (None, 1)],
    "NB": [(10_000, 3), (50_000, 5), (500_000, 3), (None, 2)],
    "RF": [(100_000, 3), (None, 2)],
    "KM": [(4_999, 3), (10_000, 5), (100_000, 3), (None, 2)],
}


def _tier(table, rows: int):
    return next(v for limit, v in table if limit is None or rows <= limit)


def default_folds(algorithm: str, rows: int) -> int:
    return _tier(DEFAULT_FOLDS[algorithm], rows)


def default_grid(algorithm: str, rows: int) -> dict[str, list]:
    """The grid of a size tier, less what the Spark estimator cannot vary.

    Neural-net regularisation has no Spark parameter, so that net's default grid
    varies the layers only. Any non-zero number in the k-means ``standardize``
    list means true.
    """
    grid = dict(_tier(DEFAULT_GRIDS[algorithm], rows))
    if algorithm == "DL":
        grid = {"hidden": grid["hidden"]}
    if algorithm == "KM":
        grid["standardize"] = sorted({bool(v) for v in grid["standardize"]})
    return grid


def combinations(grid: dict[str, list]) -> list[dict]:
    """Every combination of the hyper-parameter lists."""
    names = list(grid)
    return [dict(zip(names, values)) for values in product(*(grid[n] for n in names))]
