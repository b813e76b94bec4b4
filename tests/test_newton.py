import random

import numpy as np
import pytest

from articlemill.operators import newton

SCHEMA = "row_id int, features array<double>, label int"


def plain_fit(x, y, k, reg, rounds=60):
    """Newton's method on all rows at once, the Hessian by the definition."""
    ones = np.column_stack([x, np.ones(len(x))])
    w = np.zeros((k, ones.shape[1]))
    free = np.full(w.shape, reg)
    free[:, -1] = 0
    for _ in range(rounds):
        e = np.exp(ones @ w.T)
        p = e / e.sum(axis=1, keepdims=True)
        g = ((p - np.eye(k)[y]).T @ ones) / len(x) + free * w
        h = np.zeros((w.size, w.size))
        for row, q in zip(ones, p, strict=True):
            h += np.kron(np.diag(q) - np.outer(q, q), np.outer(row, row)) / len(x)
        w = w - (np.linalg.pinv(h + np.diag(free.ravel())) @ g.ravel()).reshape(w.shape)
    return w


def rows(n, seed=1, p=3, k=3):
    draw = random.Random(seed)
    return [(i, [draw.gauss(i % k, 1.5) * (j + 1) for j in range(p)], i % k * 2) for i in range(n)]


def test_coefficients_agree_with_a_plain_fit(spark):
    data = rows(200)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    model = newton.fit_multinomial(df, "label", reg_param=0.02, tolerance=1e-9)
    assert model.classes == [0, 2, 4] and model.gradient < 1e-9 and model.steps < 20
    expected = plain_fit(np.array([r[1] for r in data]), np.array([r[2] // 2 for r in data]), 3, 0.02)
    assert model.coefficients[:, :-1] == pytest.approx(expected[:, :-1], abs=1e-7)
    shift = model.coefficients[:, -1] - expected[:, -1]
    assert shift == pytest.approx([shift[0]] * 3, abs=1e-7)
    left = [r.gradient for r in newton.loss_gradient(model, df, "label").collect()]
    assert len(left) == 9 and max(map(abs, left)) < 1e-9
    found = {r.row_id: r for r in newton.predictions(model, df, ["row_id"]).collect()}
    p = model.probabilities(np.array([r[1] for r in data]))
    for i, row in enumerate(p):
        assert found[i].category == model.classes[int(row.argmax())] and found[i].prob == pytest.approx(row.max())


def test_sums_in_many_chunks_and_tasks_are_the_same(spark, monkeypatch):
    df = spark.createDataFrame(rows(90), SCHEMA)
    one = newton.fit_multinomial(df.coalesce(1), "label")
    monkeypatch.setattr(newton, "CHUNK", 7)
    monkeypatch.setattr(newton, "DRIVER_BYTES", 0)
    assert newton.fit_multinomial(df.repartition(9), "label").coefficients == pytest.approx(one.coefficients, abs=1e-6)


def test_separable_and_unscaled_rows_converge(spark):
    data = [(i, [1000.0 * (i % 2), float(i), 1.0], i % 2) for i in range(40)]
    model = newton.fit_multinomial(spark.createDataFrame(data, SCHEMA), "label", reg_param=1e-3)
    assert model.gradient < 1e-6
    found = newton.predictions(model, spark.createDataFrame(data, SCHEMA), ["row_id", "label"]).collect()
    assert all(r.category == r.label for r in found)


def test_odd_rows(spark):
    odd = [(100, None, 0), (101, [1.0, None, 2.0], 2), (102, [float("nan"), 0.0, 0.0], 2), (103, [1.0, 1.0, 1.0], None)]
    model = newton.fit_multinomial(spark.createDataFrame([*rows(60), *odd], SCHEMA), "label")
    assert model.coefficients == pytest.approx(newton.fit_multinomial(spark.createDataFrame(rows(60), SCHEMA), "label").coefficients)
    found = {r.row_id: r for r in newton.predictions(model, spark.createDataFrame([*odd, (104, [1.0], 0)], SCHEMA), ["row_id"]).collect()}
    assert found[100].category is None and found[104].prob is None and found[103].category in (0, 2, 4)
    none = spark.createDataFrame([], SCHEMA)
    empty = newton.fit_multinomial(none, "label")
    assert empty.classes == [] and newton.predictions(empty, none, ["row_id"]).count() == 0
    with pytest.raises(ValueError):
        newton.fit_multinomial(spark.createDataFrame([(1, [1.0], 0), (2, [1.0, 2.0], 1)], SCHEMA), "label")
    with pytest.raises(ValueError):
        newton.fit_multinomial(spark.createDataFrame([(i, [0.0] * 10, i) for i in range(400)], SCHEMA), "label")
