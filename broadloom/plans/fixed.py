"""Fixed settings shared by registered queries and their SQL twins: cut points, weights, options."""

from __future__ import annotations

import numpy as np

from broadloom.operators.dense import DenseModel
from broadloom.operators.network import DenseSpec, initial

BOOST_FEATURES = ["l_quantity", "l_discount", "l_tax"]
BOOST_EDGES = [[5.0 * i for i in range(1, 11)], [i / 100 for i in range(1, 11)], [i / 100 for i in range(1, 9)]]
CLASSIFY = {"objective": "binary:logistic", "eta": 0.3, "gamma": 0.1, "reg_lambda": 1.0, "min_child_weight": 30.0,
            "pos_weight": 2.0, "max_depth": 2, "num_round": 3}
REGRESS = {"objective": "reg:squarederror", "eta": 0.3, "gamma": 0.1, "reg_lambda": 1.0, "min_child_weight": 30.0,
           "pos_weight": 1.0, "max_depth": 2, "num_round": 3}
SEARCH = {"eta": 0.5, "min_child_weight": 3.0}
TRIALS = {"gamma": 0.1, "reg_lambda": 1.0, "min_child_weight": 30.0, "pos_weight": 1.0}
TRIAL_ROUNDS, TRIAL_DEPTHS, TRIAL_RATES = [1, 3], [1, 2], [0.3, 0.9]
HISTORY = 64
WIDE_HISTORY = 200
WIDE_EMBEDDINGS = {"kind": (6, 4), "hour": (25, 8), "weekday": (8, 8), "day": (32, 16), "minute": (61, 32), "slot": (500, 600)}  # rows, width
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def weight(i: int, j: int) -> float:
    return ((i * 7 + j * 3) % 11 - 5) / 10


def bias(j: int) -> float:
    return (j % 3 - 1) / 10


def embed(i: int, d: int) -> float:
    return ((i * 5 + d * 3) % 7 - 3) / 4


def fixed_model(spec: DenseSpec) -> DenseModel:
    """Model whose parameters follow the rules above, so SQL can repeat its scores."""
    params = {}
    for name, a in initial(spec).items():
        part = name.split("/")[1]
        if part in ("weight", "table"):
            rule = weight if part == "weight" else embed
            params[name] = np.array([[rule(i, j) for j in range(a.shape[1])] for i in range(a.shape[0])])
        elif part == "bias":
            params[name] = np.array([bias(j) for j in range(len(a))])
        else:
            params[name] = a
    return DenseModel(spec, params)
