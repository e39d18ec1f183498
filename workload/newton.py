"""Oracle SQL of generalised linear models: Newton's steps written out, one view each.

A step sums gradient and Hessian over the distinct rows and solves by Gauss-Jordan elimination,
every pivot a nested SELECT. The last step's inverse Hessian gives the standard errors.
"""

from __future__ import annotations

STEPS = 12


def glm_views(name: str, source: str, label: str, terms: dict[str, str], family: str = "binomial") -> dict[str, str]:
    """Views up to ``w_{name}`` (term, estimate, std_error, statistic, p_value) and ``w_{name}_b`` (b0, b1, ...).

    ``terms`` maps names to expressions over ``source``; rows with a missing value are left out. The
    intercept is b0 and the last row.
    """
    p = len(terms) + 1
    index = range(p)
    columns = ", ".join(f"cast({e} AS double) AS x{i}" for i, e in enumerate(terms.values(), 1))
    known = " AND ".join(f"x{i} IS NOT NULL" for i in index[1:])
    views = {
        f"w_{name}_rows": f"""
        SELECT *, cast(1 AS double) AS x0, cast(count(*) AS double) AS times
        FROM (SELECT cast({label} AS double) AS y, {columns} FROM {source})
        WHERE y IS NOT NULL AND {known} GROUP BY ALL""",
    }
    start = f"(SELECT ln(sum(y * times) / sum(times)) FROM $w_{name}_rows)" if family == "poisson" else "cast(0 AS double)"
    views[f"w_{name}_0"] = f"SELECT {start} AS b0, " + ", ".join(f"cast(0 AS double) AS b{i}" for i in index[1:])
    line = " + ".join(f"b{i} * x{i}" for i in index)
    mean = f"exp({line})" if family == "poisson" else f"1 / (1 + exp(-({line})))"
    weight = "m" if family == "poisson" else "m * (1 - m)"
    kept = ", ".join(f"b{i}" for i in index)
    for step in range(1, STEPS + 1):
        sums = [f"sum(times * x{i} * x{j} * {weight}) AS a{i}_{j}" for i in index for j in index]
        sums += [f"sum(times * x{i} * (y - m)) AS a{i}_{p}" for i in index]
        sums += [f"cast({int(i == j)} AS double) AS a{i}_{p + 1 + j}" for i in index for j in index]
        sums += [f"any_value(b{i}) AS b{i}" for i in index]
        text = f"SELECT {', '.join(sums)} FROM (SELECT *, {mean} AS m FROM $w_{name}_rows, $w_{name}_{step - 1})"
        for k in index:
            cells = []
            for i in index:
                for j in range(2 * p + 1):
                    pivot = f"a{k}_{j} / a{k}_{k}"
                    cells.append(f"{pivot if i == k else f'a{i}_{j} - a{i}_{k} * {pivot}'} AS a{i}_{j}")
            text = f"SELECT {kept}, {', '.join(cells)} FROM ({text})"
        views[f"w_{name}_{step}"] = (
            "SELECT " + ", ".join(f"b{i} + a{i}_{p} AS b{i}, sqrt(a{i}_{p + 1 + i}) AS e{i}" for i in index) + f" FROM ({text})"
        )
    views[f"w_{name}_b"] = f"SELECT * FROM $w_{name}_{STEPS}"
    rows = " UNION ALL ".join(
        f"SELECT '{t}' AS term, b{i} AS estimate, e{i} AS std_error FROM $w_{name}_b"
        for i, t in [*enumerate(terms, 1), (0, "(Intercept)")]
    )
    # both tails of the normal distribution; nothing is left of them in six digits beyond 6
    x = "(abs(estimate / std_error) / sqrt(2))"
    series = f"""list_sum(list_transform(range(0, 120), lambda n:
        CASE WHEN n % 2 = 0 THEN 1 ELSE -1 END * exp((2 * n + 1) * ln({x}) - lgamma(n + 1)) / (2 * n + 1)))"""
    views[f"w_{name}"] = f"""
        SELECT term, estimate, std_error, estimate / std_error AS statistic,
               CASE WHEN {x} > 4.2 THEN 0 ELSE 1 - 2 / sqrt(pi()) * {series} END AS p_value
        FROM ({rows})"""
    return views
