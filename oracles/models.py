"""Penalised linear models as SQL, by other means than the engine's: elimination and coordinate descent over
the moments. Each function gives named table expressions, in order."""

from __future__ import annotations

from oracles.lists import MODEL_FEATURES

N = len(MODEL_FEATURES)
SWEEPS = 300


SCALE = ", ".join(f"avg(x{i}) as a{i}, coalesce(nullif(stddev_pop(x{i}), 0), 1) as s{i}" for i in range(1, N + 1))
Z = ", ".join(f"(x{i} - a{i}) / s{i}" for i in range(1, N + 1))


def _filled(train: str) -> str:
    return ", ".join(f"coalesce({c}::double, avg({c}::double) filter ({train}) over ()) as x{i}" for i, c in enumerate(MODEL_FEATURES, 1))


def _gram() -> str:
    cell = lambda i, j: f"sum(z[{min(i, j)}] * z[{max(i, j)}])"
    g = ", ".join("[" + ", ".join(cell(i, j) for j in range(1, N + 1)) + "]" for i in range(1, N + 1))
    return f"[{g}] as g, [{', '.join(f'sum(z[{i}] * (y - m))' for i in range(1, N + 1))}] as b"


def moments(train: str = "split = 'train'", source: str = "parted") -> dict[str, str]:
    """``m_z`` (inputs on the training part's scale, NULLs filled by its means) and ``m_gram``: g = Z'Z,
    b = Z'(y - mean), n and the mean m."""
    return {
        "m_filled": f"select *, avg_temperature as y, {_filled(train)} from {source}",
        "m_scale": f"select avg(y) as m, {SCALE} from m_filled where {train}",
        "m_z": f"select m_filled.*, m, [{Z}] as z from m_filled, m_scale",
        "m_gram": f"select any_value(m) as m, count(*) as n, {_gram()} from m_z where {train}",
    }


def fold_moments(splits: int = 5) -> dict[str, str]:
    """The same for each fold ``t`` of the training part: the blocks of time before it."""
    return {
        "m_filled": f"select date, avg_temperature as y, {_filled('true')} from parted where split = 'train'",
        "m_block": f"""select date, least({splits}, floor((sum(c) over (order by date) - c) * {splits + 1} / sum(c) over ())) as block
          from (select date, count(*) as c from m_filled group by date)""",
        "m_rows": f"select * from m_filled join m_block using (date), range(1, {splits + 1}) as f(t) where block <= t",
        "m_scale": f"select t, avg(y) as m, {SCALE} from m_rows where block < t group by t",
        "m_z": f"select t, block, y, m, [{Z}] as z from m_rows join m_scale using (t)",
        "m_gram": f"select t, any_value(m) as m, count(*) as n, {_gram()} from m_z where block < t group by t",
    }


def ridge(alpha: float = 1.0, least: float = 0.0, keep: str = "") -> dict[str, str]:
    """(g + alpha I) w = b by elimination; the matrix is positive definite, so no rows are exchanged. Without
    alpha, inputs that others determine (their pivot is at most ``least`` of n) get no weight."""
    start = f"list_transform(g, lambda r, i: list_append(list_transform(r, lambda v, j: v + if(i = j, {alpha}, 0e0)), b[i]))"
    step = "list_transform(a, lambda r, i: list_transform(r, lambda v, j: if(i = k, v / a[k][k], v - r[k] * a[k][j] / a[k][k])))"
    if least:
        out = "list_transform(a, lambda r, i: list_transform(r, lambda v, j: if(i = k or j = k, 0e0, v)))"
        step = f"if(a[k][k] > {least} * n, {step}, {out})"
    return {
        "w_steps": f"select {keep} 1 as k, n, {start} as a from m_gram union all select {keep} k + 1, n, {step} from w_steps where k <= {N}",
        "w_found": f"select {keep} list_transform(a, lambda r: r[{N + 1}]) as w from w_steps where k = {N + 1}",
    }


def descent(l1: float, l2: float) -> dict[str, str]:
    """1/(2n) RSS + l1 |w| + l2/2 |w|^2, one coordinate at a time."""
    rho = "((b[j] - list_dot_product(g[j], w) + g[j][j] * w[j]) / n)"
    new = f"sign({rho}) * greatest(abs({rho}) - {l1}, 0) / (g[j][j] / n + {l2})"
    return {
        "w_steps": f"""select 0 as k, list_transform(b, lambda v: 0e0) as w from m_gram union all
          select k + 1, list_transform(w, lambda v, i: if(i = j, u, v)) from
          (select k, w, j, {new} as u from (select k, w, k % {N} + 1 as j from w_steps where k < {N * SWEEPS}), m_gram)""",
        "w_found": f"select w from w_steps where k = {N * SWEEPS}",
    }


PREDICTED = "select m_z.*, m + list_dot_product(z, w) as prediction from m_z, w_found where split = 'test'"
FOLD_ERRORS = """select t as fold, sqrt(avg(pow(y - m - list_dot_product(z, w), 2))) as rmse
  from m_z join w_found using (t) where block = t group by t"""
