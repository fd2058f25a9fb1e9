"""SQL for regression checks: least squares by elimination in a recursive query, tails by Simpson's rule."""

from __future__ import annotations


def t_tail(t: str, dof: str) -> str:
    """Two-sided tail of the t distribution by Simpson's rule with 2,000 steps."""
    weight = "CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    area = f"list_sum(list_transform(range(0, 2001), lambda i: ({weight}) * pow(1 + pow(abs({t}) / 2000 * i, 2) / ({dof}), -(({dof}) + 1) / 2.0))) * abs({t}) / 6000"
    return f"greatest(0, 1 - 2 * exp(lgamma((({dof}) + 1) / 2.0) - lgamma(({dof}) / 2.0)) / sqrt(({dof}) * pi()) * ({area}))"


def f_tail(f: str, d1: str, d2: str) -> str:
    """Upper tail of the F distribution: incomplete beta integral up to d2 / (d2 + d1 f), by Simpson's rule."""
    x = f"(({d2}) / (({d2}) + ({d1}) * ({f})))"
    weight = "CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    u = f"({x} / 4000 * i)"
    area = f"list_sum(list_transform(range(0, 4001), lambda i: ({weight}) * pow({u}, ({d2}) / 2.0 - 1) * pow(1 - {u}, ({d1}) / 2.0 - 1))) * {x} / 12000"
    return f"({area}) * exp(lgamma((({d1}) + ({d2})) / 2.0) - lgamma(({d1}) / 2.0) - lgamma(({d2}) / 2.0))"


def ols(name: str, rows: str, y: str, features: list[str], group: str = "0") -> dict[str, str]:
    """WITH entries ending in `name`(g, n, k, b, intercept, r2, adj_r2, f_stat, inv): one row per group.

    Rows with a NULL are left out. Features are centred per group, the normal equations (with an identity block for
    the inverse) are eliminated column by column.
    """
    k = len(features)
    complete = " AND ".join(f"{c} IS NOT NULL" for c in [y, *features])
    centred = ", ".join(f"{c} - avg({c}) OVER (PARTITION BY g) AS x{i}, avg({c}) OVER (PARTITION BY g) AS a{i}" for i, c in enumerate(features))
    line = lambda i: "[" + ", ".join([f"sum(x{i} * x{j})" for j in range(k)] + [f"sum(x{i} * yc)"] + ["1.0::DOUBLE" if j == i else "0.0::DOUBLE" for j in range(k)]) + "]"
    means = "[" + ", ".join(f"min(a{i})" for i in range(k)) + "]"
    return {
        f"{name}_rows": f"SELECT {group} AS g, {y} AS y0, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in features) + f" FROM {rows} WHERE {complete}",
        f"{name}_centred": f"SELECT g, y0 - avg(y0) OVER (PARTITION BY g) AS yc, avg(y0) OVER (PARTITION BY g) AS ya, {centred} FROM {name}_rows",
        f"{name}_gram": f"SELECT g, count(*) AS n, min(ya) AS ya, sum(yc * yc) AS yy, {means} AS means, [{', '.join(f'sum(x{i} * yc)' for i in range(k))}] AS xy, [{', '.join(line(i) for i in range(k))}] AS m FROM {name}_centred GROUP BY g",
        f"{name}_steps": f"""SELECT g, 1 AS step, m FROM {name}_gram UNION ALL SELECT g, step + 1, list_transform(m, lambda line, i: CASE WHEN i = step
  THEN list_transform(line, lambda v: v / m[step][step]) ELSE list_transform(line, lambda v, j: v - line[step] * m[step][j] / m[step][step]) END)
  FROM {name}_steps WHERE step <= {k}""",
        f"{name}_solved": f"SELECT s.g, n, ya, yy, means, xy, list_transform(s.m, lambda line: line[{k + 1}]) AS b, list_transform(s.m, lambda line, i: line[{k + 1} + i]) AS inv FROM {name}_steps s JOIN {name}_gram USING (g) WHERE step = {k + 1}",
        f"{name}_r2": f"SELECT *, list_sum(list_transform(range(1, {k + 1}), lambda i: b[i] * xy[i])) / yy AS r2, ya - list_sum(list_transform(range(1, {k + 1}), lambda i: b[i] * means[i])) AS intercept FROM {name}_solved",
        name: f"SELECT g, n, {k} AS k, b, inv, intercept, r2, 1 - (1 - r2) * (n - 1) / (n - {k} - 1) AS adj_r2, (r2 / {k}) / ((1 - r2) / (n - {k} - 1)) AS f_stat, (1 - r2) * yy / (n - {k} - 1) AS mse FROM {name}_r2",
    }


def logistic(name: str, train: str, y: str, features: list[str], steps: int = 150) -> dict[str, str]:
    """WITH entries ending in `name`(b0, w): L2 logistic regression on columns that are already standardised.

    The penalty is |w|^2 / (2 n) per mean loss. Every step solves with the fixed bound of the Hessian (a quarter of
    the correlation matrix), which converges to the same optimum as any other method.
    """
    k = len(features)
    score = " + ".join(["b0", *[f"w[{i + 1}] * {f}" for i, f in enumerate(features)]])
    grad = "[" + ", ".join(f"avg((p - y) * {f}) + min(w[{i + 1}]) / count(*)" for i, f in enumerate(features)) + "]"
    return {
        **ols(f"{name}_pre", train, y, features),
        f"{name}_inverse": f"SELECT list_transform(m, lambda line: line[{k + 2}:{2 * k + 1}]) AS inv FROM {name}_pre_steps WHERE step = {k + 1}",
        f"{name}_steps": f"""SELECT 0 AS step, 0.0::DOUBLE AS b0, [{', '.join(['0.0::DOUBLE'] * k)}] AS w UNION ALL
  SELECT step + 1, b0 - 4 * g0, list_transform(w, lambda v, i: v - 4 * n * list_dot_product(inv[i], g)) FROM (
    SELECT step, b0, w, count(*) AS n, avg(p - y) AS g0, {grad} AS g FROM (
      SELECT step, b0, w, {y} AS y, {', '.join(features)}, 1 / (1 + exp(-({score}))) AS p FROM {name}_steps, {train} WHERE step < {steps}) GROUP BY step, b0, w) JOIN {name}_inverse ON true""",
        name: f"SELECT b0, w FROM {name}_steps WHERE step = {steps}",
    }
