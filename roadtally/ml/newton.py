"""Class-balanced multinomial logistic regression by Newton steps over group counts.

The rows are groups of equal rows with a weight, as many as there are combinations of categories. Each step sums the loss, its
gradient and its Hessian in one aggregation by pairs of slots; what reaches the driver is the square of the number of
slots, whatever the number of rows, and a system of a few dozen unknowns is solved there. The optimum is reached to
rounding, so any other exact method gives the same coefficients.

Where the slots of a feature add up to the intercept, and where all classes move alike, only the penalty counts, and rounding
that grows with the rows would move the coefficients at every step. So the gradient is summed in decimals, and that of
the last class is what the others leave, as the probabilities of a row add up to 1.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_STEPS = 50
# Largest change of a coefficient in the last step.
TOLERANCE = 1e-10
# What the parts of the gradient are summed as.
EXACT = "decimal(38,18)"


def _scores(classes: int, weights: np.ndarray) -> list[Column]:
    """The linear score of each class: the coefficients of a row's slots, of which slot 0 is the intercept."""
    tables = [F.array(*[F.lit(float(w)) for w in weights[k]]) for k in range(classes)]
    total = lambda table: F.aggregate("slots", F.lit(0.0), lambda sum_, s: sum_ + F.element_at(table, s + 1))
    return [total(table) for table in tables]


def _sums(rows: DataFrame, classes: int, weights: np.ndarray, slots: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient by class and slot, and Hessian, without the penalty; each summed over the weighted rows."""
    scored = rows.withColumn("z", F.array(*_scores(classes, weights)))
    scored = scored.withColumn("top", F.array_max("z"))
    scored = scored.withColumn("e", F.transform("z", lambda z: F.exp(z - F.col("top"))))
    scored = scored.withColumn("norm", F.aggregate("e", F.lit(0.0), lambda a, b: a + b))
    scored = scored.withColumn("p", F.transform("e", lambda e: e / F.col("norm")))
    own = F.element_at("z", F.col("label") + 1) - F.col("top") - F.log("norm")
    pairs = scored.select(
        "weight", "label", "p", own.alias("log_p"), "slots", F.explode("slots").alias("i")
    ).select("weight", "label", "p", "log_p", "i", F.explode("slots").alias("j"))
    p = [F.element_at("p", k + 1) for k in range(classes)]
    wanted = [F.sum(-F.col("weight") * F.col("log_p")).alias("loss")]
    off = [F.sum((F.col("weight") * (p[k] - (F.col("label") == k).cast("int"))).cast(EXACT)) for k in range(classes - 1)]
    wanted += [total.cast("double").alias(f"g{k}") for k, total in enumerate(off)]
    wanted.append(sum(off, F.lit(0).cast(EXACT)).cast("double").alias("g_others"))
    for k in range(classes):
        wanted += [F.sum(F.col("weight") * p[k] * (int(k == m) - p[m])).alias(f"h{k}_{m}") for m in range(classes)]
    loss, gradient = 0.0, np.zeros((classes, slots))
    hessian = np.zeros((classes, slots, classes, slots))
    for r in pairs.groupBy("i", "j").agg(*wanted).collect():
        i, j = r["i"], r["j"]
        if i == j == 0:
            loss = r["loss"]
        if i == j:
            gradient[:-1, i] = [r[f"g{k}"] for k in range(classes - 1)]
            gradient[-1, i] = -r["g_others"]
        for k in range(classes):
            for m in range(classes):
                hessian[k, i, m, j] = r[f"h{k}_{m}"]
    return loss, gradient, hessian


def newton(rows: DataFrame, classes: int, slots: int, penalty: float = 1.0) -> np.ndarray:
    """Coefficients by class and slot of ``rows(slots array<int>, label int, weight double)``.

    They minimise the weighted log loss plus half the penalty times their squares, those of slot 0 (the intercepts)
    excepted, which add up to 0. Every row holds slot 0. A step that does not lower the loss is halved.
    """
    penalised = np.ones((classes, slots)) * penalty
    penalised[:, 0] = 0
    # Adding one number to all intercepts changes nothing; this keeps the system regular and their sum at 0.
    level = np.zeros((classes, slots, classes, slots))
    level[:, 0, :, 0] = 1.0
    size = classes * slots
    weights = np.zeros((classes, slots))
    loss, gradient, hessian = _sums(rows, classes, weights, slots)
    for _ in range(MAX_STEPS):
        matrix = (hessian + level).reshape(size, size) + np.diag(penalised.ravel())
        step = np.linalg.solve(matrix, (gradient + penalised * weights).ravel()).reshape(classes, slots)
        before = loss + (penalised * weights**2).sum() / 2
        while True:
            loss, gradient, hessian = _sums(rows, classes, weights - step, slots)
            after = loss + (penalised * (weights - step) ** 2).sum() / 2
            if after <= before + 1e-12 * abs(before) or np.abs(step).max() < TOLERANCE:
                break
            step = step / 2
        weights = weights - step
        if np.abs(step).max() < TOLERANCE:
            return weights
    raise RuntimeError(f"coefficients still move by {np.abs(step).max()} after {MAX_STEPS} steps")
