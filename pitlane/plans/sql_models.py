"""DuckDB SQL of fitted models, for the oracles: independent solvers over the plain rows.

Each function gives CTEs for `WITH RECURSIVE`. Rows come from a CTE `<t>_src(model, x, y)`
with a list x of features, where NULL counts as the model's mean."""

from __future__ import annotations


def _each(p: int, item: str) -> str:
    """A list of p items, `$` being their number from 1."""
    return "[" + ", ".join(item.replace("$", str(i)) for i in range(1, p + 1)) + "]"


def standardised(t: str, p: int) -> str:
    """`<t>_z(model, x, y, ...)`: standardised features and centred y, and `<t>_sc`, their means and deviations by model."""
    return f"""{t}_st AS (SELECT model, avg(y) AS ybar, count(*) AS n, {_each(p, "coalesce(avg(x[$]), 0)")} AS mean FROM {t}_src GROUP BY model),
{t}_c AS (SELECT model, {_each(p, "coalesce(x[$] - mean[$], 0)")} AS x, y - ybar AS y, y AS y_raw FROM {t}_src JOIN {t}_st USING (model)),
{t}_sc AS (SELECT s.*, v.sd FROM {t}_st s JOIN (SELECT model, {_each(p, "CASE WHEN avg(x[$] * x[$]) > 0 THEN sqrt(avg(x[$] * x[$])) ELSE 1 END")} AS sd FROM {t}_c GROUP BY model) v USING (model)),
{t}_z AS (SELECT model, {_each(p, "c.x[$] / sd[$]")} AS x, c.y, c.y_raw FROM {t}_c c JOIN {t}_sc USING (model))"""


def gram(t: str, p: int) -> str:
    """`<t>_g(model, i, line, r)`: the lines of the Gram matrix and its right-hand side."""
    return f"""{t}_g AS (SELECT model, i, list(s ORDER BY j) FILTER (WHERE j <= {p}) AS line, max(s) FILTER (WHERE j > {p}) AS r
  FROM (SELECT model, i, j, sum(x[i] * CASE WHEN j <= {p} THEN x[j] ELSE y END) AS s FROM {t}_z, range(1, {p + 1}) a(i), range(1, {p + 2}) b(j) GROUP BY model, i, j) GROUP BY model, i)"""


def eliminated(t: str, p: int) -> str:
    """`<t>_gj(model, cand, k, m)`: elimination of `<t>_m(model, cand, m)` column by column; done at k = p + 1."""
    return f"""{t}_gj AS (SELECT model, cand, 1 AS k, m FROM {t}_m
  UNION ALL SELECT model, cand, k + 1, list_transform(m, lambda line, i: CASE WHEN i = k THEN list_transform(line, lambda v: v / m[k][k])
      ELSE list_transform(line, lambda v, j: v - line[k] / m[k][k] * m[k][j]) END) FROM {t}_gj WHERE k <= {p})"""


def ridge(t: str, p: int) -> str:
    """`<t>_fit(model, cand, ybar, mean, beta)` for the penalties in `<t>_cand(cand, alpha)`."""
    return f"""{standardised(t, p)}, {gram(t, p)},
{t}_m AS (SELECT model, cand, list(list_append(list_transform(line, lambda v, j: CASE WHEN j = i THEN v + alpha ELSE v END), r) ORDER BY i) AS m FROM {t}_g, {t}_cand GROUP BY model, cand),
{eliminated(t, p)},
{t}_fit AS (SELECT model, cand, ybar, mean, list_transform(m, lambda line, i: line[{p + 1}] / sd[i]) AS beta FROM {t}_gj JOIN {t}_sc USING (model) WHERE k = {p + 1})"""


def value(x: str, f: str = "") -> str:
    """The fitted value at a list x, columns of the fit by prefix f."""
    return f"({f}ybar + list_sum(list_transform({x}, lambda v, i: coalesce(v - {f}mean[i], 0) * {f}beta[i])))"


def elastic_net(t: str, p: int, sweeps: int = 300) -> str:
    """`<t>_fit` for `<t>_cand(cand, l1, l2)`: coordinate after coordinate, the penalties those of half the mean square."""
    return f"""{standardised(t, p)}, {gram(t, p)},
{t}_q AS (SELECT model, list(line ORDER BY i) AS q, list(r ORDER BY i) AS r FROM {t}_g GROUP BY model),
{t}_cd AS (SELECT model, cand, 0 AS it, list_transform(r, lambda v: 0.0::DOUBLE) AS b FROM {t}_q, {t}_cand
  UNION ALL SELECT d.model, d.cand, it + 1, list_transform(b, lambda v, j: CASE WHEN j <> 1 + it % {p} THEN v ELSE
      sign(r[j] - list_dot_product(q[j], b) + q[j][j] * v) * greatest(abs(r[j] - list_dot_product(q[j], b) + q[j][j] * v) - l1 * n, 0) / (q[j][j] + l2 * n) END)
    FROM {t}_cd d JOIN {t}_q USING (model) JOIN {t}_cand c ON c.cand = d.cand JOIN {t}_st s ON s.model = d.model WHERE it < {p * sweeps}),
{t}_fit AS (SELECT d.model, cand, ybar, mean, list_transform(b, lambda v, i: v / sd[i]) AS beta FROM {t}_cd d JOIN {t}_sc s ON s.model = d.model WHERE it = {p * sweeps})"""


def penalised_logit(t: str, p: int, steps: int = 150) -> str:
    """`<t>_fit(ybar, mean, beta)`, one model: balanced weights, unit penalty on all coefficients, the intercept (ybar) too.

    Steps go by a fixed bound of the information, a quarter of the weighted products plus the penalty, whose inverse is eliminated once."""
    k = p + 1
    unit = "list_transform(range(1, %d), lambda j: CASE WHEN j = i THEN 1.0 ELSE 0.0 END)" % (k + 1)
    return f"""{standardised(t, p)},
{t}_w AS (SELECT list_append(x, 1.0) AS x, y_raw AS y, (SELECT count(*) FROM {t}_src) / (2.0 * count(*) OVER (PARTITION BY y_raw)) AS w FROM {t}_z),
{t}_m AS (SELECT 0 AS model, 0 AS cand, list(list_concat(line, {unit}) ORDER BY i) AS m
  FROM (SELECT i, list(s ORDER BY j) AS line FROM (SELECT i, j, sum(w * x[i] * x[j]) / 4 + CASE WHEN i = j THEN 1 ELSE 0 END AS s FROM {t}_w, range(1, {k + 1}) a(i), range(1, {k + 1}) b(j) GROUP BY i, j) GROUP BY i)),
{eliminated(t, k)},
{t}_inv AS (SELECT list_transform(m, lambda line: line[{k + 1}:{2 * k}]) AS inv FROM {t}_gj WHERE k = {k + 1}),
{t}_it AS (SELECT 0 AS it, list_transform(range({k}), lambda v: 0.0::DOUBLE) AS b
  UNION ALL SELECT it + 1, list_transform(b, lambda v, i: v + list_dot_product(inv[i], list_transform(g, lambda s, j: s - b[j])))
    FROM (SELECT any_value(it) AS it, any_value(b) AS b, {_each(k, "sum(w * (y - 1 / (1 + exp(-list_dot_product(x, b)))) * x[$])")} AS g FROM {t}_it, {t}_w WHERE it < {steps} HAVING count(*) > 0), {t}_inv),
{t}_fit AS (SELECT b[{k}] AS ybar, mean, {_each(p, "b[$] / sd[$]")} AS beta FROM {t}_it, {t}_sc WHERE it = {steps})"""


def erfc(x: str) -> str:
    """The complementary error function of x > 0, by a series of positive terms."""
    return f"greatest(0, 1 - list_sum(list_transform(range(250), lambda k: exp(-{x} * {x} + (2 * k + 1) * ln({x}) - lgamma(k + 1.5)))))"
