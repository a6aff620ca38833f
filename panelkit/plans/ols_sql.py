"""SQL for least squares by orthogonalisation, to check fits without a matrix solver."""

from __future__ import annotations


def ols_ctes(source: str, y: str, xs: list[str], partition: str = "") -> tuple[list[str], str]:
    """CTEs ending in a table with, per row, coefficients ``b0..``, row weights ``w0..``, leverage ``h``, residual ``e``.

    Column 0 is the constant. Columns are made orthogonal one after another (``q``); back substitution over the
    projection factors gives coefficients and, row by row, each row's weight in every coefficient.
    """
    over = f"OVER (PARTITION BY {partition})" if partition else "OVER ()"
    p = len(xs) + 1
    x = ["1.0::DOUBLE", *xs]
    ctes, last = [], source
    ctes.append(f"o0 AS (SELECT *, 1.0::DOUBLE AS q0 FROM {last})")
    for j in range(1, p):
        factors = ", ".join(f"sum(({x[j]}) * q{i}) {over} / sum(q{i} * q{i}) {over} AS r{i}_{j}" for i in range(j))
        ctes.append(f"f{j} AS (SELECT *, {factors} FROM o{j - 1})")
        rest = " ".join(f"- r{i}_{j} * q{i}" for i in range(j))
        ctes.append(f"o{j} AS (SELECT *, ({x[j]}) {rest} AS q{j} FROM f{j})")
    sums = ", ".join(f"sum(q{j} * q{j}) {over} AS d{j}, sum(({y}) * q{j}) {over} / sum(q{j} * q{j}) {over} AS c{j}" for j in range(p))
    ctes.append(f"s{p} AS (SELECT *, {sums}, count(*) {over} AS n FROM o{p - 1})")
    last = f"s{p}"
    for j in reversed(range(p)):
        beta = " ".join(f"- r{j}_{k} * b{k}" for k in range(j + 1, p))
        weight = " ".join(f"- r{j}_{k} * w{k}" for k in range(j + 1, p))
        ctes.append(f"s{j} AS (SELECT *, c{j} {beta} AS b{j}, q{j} / d{j} {weight} AS w{j} FROM {last})")
        last = f"s{j}"
    lever = " + ".join(f"q{j} * q{j} / d{j}" for j in range(p))
    fit = " + ".join(f"b{j} * ({x[j]})" for j in range(p))
    ctes.append(f"fitted AS (SELECT *, {lever} AS h, ({y}) - ({fit}) AS e FROM {last})")
    return ctes, "fitted"
