"""Maximum likelihood in DuckDB SQL: a recursive query whose every step is one of Newton's.

Independent of the operators: derivatives are differences of the objective by the logarithms of the parameters, systems
are solved by Cramer's rule, and of several damped and stretched steps the one with the least objective is taken.
"""

from __future__ import annotations

from itertools import combinations, permutations

STEP = 2e-3
ROUNDS = 40
# Added to the curvatures, and how far to go along the step that follows.
DAMPING = (0.0, 1e-6, 1e-4, 1e-2, 1.0, 100.0)
STRETCH = (1.0, 4.0)
# Curvature by a parameter's logarithm below which the data do not determine it; it is held fixed for the others' errors.
LEAST_CURVATURE = 1e-4


def _determinant(cells: list[list[str]]) -> str:
    size, terms = len(cells), []
    if not size:
        return "1"
    for order in permutations(range(size)):
        odd = sum(order[i] > order[j] for i, j in combinations(range(size), 2)) % 2
        terms.append(("- " if odd else "+ ") + " * ".join(cells[i][order[i]] for i in range(size)))
    return f"({' '.join(terms)})"


def _offsets(size: int) -> list[tuple[int, ...]]:
    """Points around the current one, in steps."""
    out = [(0,) * size]
    for i in range(size):
        out += [tuple(by if k == i else 0 for k in range(size)) for by in (-2, -1, 1, 2)]
    for i, j in combinations(range(size), 2):
        for a in (-1, 1):
            out += [tuple(a if k == i else b if k == j else 0 for k in range(size)) for b in (-1, 1)]
    return out


def _objective(points: str, keys: list[str], size: int, row: str, rows: str, penalizer: float) -> str:
    """``keys``, ``t0`` and on, and ``f`` at each of ``points``; ``row`` is a row's log-likelihood in ``p0`` and on."""
    places = [f"t{i}" for i in range(size)]
    values = ", ".join(f"exp({t}) AS p{i}" for i, t in enumerate(places))
    squares = " + ".join(f"any_value(p{i}) * any_value(p{i})" for i in range(size))
    names = ", ".join([*keys, *places])
    return f"""(SELECT {names}, {penalizer!r}::DOUBLE * ({squares}) - sum(w * {row}) / sum(w) AS f
                FROM (SELECT *, {values} FROM {points}) q, {rows} GROUP BY {names})"""


def _derivatives(source: str, size: int, row: str, rows: str, penalizer: float) -> str:
    """``k``, the point, slopes ``g0`` and on, and curvatures ``h00`` and on."""
    offsets = _offsets(size)
    table = ", ".join(f"({n}, {', '.join(f'{o * STEP!r}::DOUBLE' for o in offset)})" for n, offset in enumerate(offsets))
    moved = ", ".join(f"c{i} + o{i} AS t{i}" for i in range(size))
    centre = ", ".join(f"t{i} AS c{i}" for i in range(size))
    points = f"""(SELECT k, n, {', '.join(f'c{i}' for i in range(size))}, {moved}
                  FROM (SELECT k, {centre} FROM {source}), (VALUES {table}) AS st(n, {', '.join(f'o{i}' for i in range(size))}))"""

    def at(**moves: int) -> str:
        offset = tuple(moves.get(f"m{i}", 0) for i in range(size))
        return f"max(f) FILTER (WHERE n = {offsets.index(offset)})"

    columns = [f"any_value(c{i}) AS t{i}" for i in range(size)]
    for i in range(size):
        m = f"m{i}"
        columns.append(f"({at(**{m: -2})} - 8 * {at(**{m: -1})} + 8 * {at(**{m: 1})} - {at(**{m: 2})}) / {12 * STEP!r} AS g{i}")
        columns.append(
            f"(16 * ({at(**{m: -1})} + {at(**{m: 1})}) - {at(**{m: -2})} - {at(**{m: 2})} - 30 * {at()}) / {12 * STEP**2!r} AS h{i}{i}"
        )
    for i, j in combinations(range(size), 2):
        a, b = f"m{i}", f"m{j}"
        corners = [at(**{a: x, b: y}) for x, y in ((1, 1), (-1, -1), (1, -1), (-1, 1))]
        columns.append(f"({corners[0]} + {corners[1]} - {corners[2]} - {corners[3]}) / {4 * STEP**2!r} AS h{i}{j}")
    keys = ["k", "n", *[f"c{i}" for i in range(size)]]
    return f"(SELECT k, {', '.join(columns)} FROM {_objective(points, keys, size, row, rows, penalizer)} GROUP BY k)"


def _curvature(i: int, j: int, damping: str = "") -> str:
    cell = f"h{min(i, j)}{max(i, j)}"
    return f"({cell} + {damping})" if damping and i == j else cell


def _held(i: int, j: int) -> str:
    """A curvature, with those of undetermined parameters as in the identity."""
    return f"(CASE WHEN least(h{i}{i}, h{j}{j}) >= {LEAST_CURVATURE!r} THEN {_curvature(i, j)} ELSE {float(i == j)!r} END)"


def newton_ctes(size: int, row: str, rows: str, penalizer: float, start: float = 0.1) -> str:
    """CTEs ``fit`` (all points of the search) and ``fitted``: ``t0`` and on (logarithms of the parameters), ``e0`` and on
    (their variances times the weight of all rows).

    ``rows`` is a table with the weight ``w``.
    """
    places = [f"t{i}" for i in range(size)]
    cells = [[_curvature(i, j, "damping") for j in range(size)] for i in range(size)]
    steps = []
    for i in range(size):
        turned = [[f"g{r}" if c == i else cells[r][c] for c in range(size)] for r in range(size)]
        step = f"-stretch * {_determinant(turned)} / nullif({_determinant(cells)}, 0)"
        steps.append(f"t{i} + least(greatest(coalesce({step}, 0), -2), 2) AS t{i}")
    choices = ", ".join(f"({d!r}::DOUBLE, {s!r}::DOUBLE)" for d in DAMPING for s in (*STRETCH, 0.0))
    points = f"""(SELECT DISTINCT k, {', '.join(steps)} FROM {_derivatives('fit', size, row, rows, penalizer)},
                  (VALUES {choices}) AS choices(damping, stretch))"""
    tried = _objective(points, ["k"], size, row, rows, penalizer)
    packed = ", ".join(f"'{t}': {t}" for t in places)
    plain = [[_held(i, j) for j in range(size)] for i in range(size)]
    spread = []
    for i in range(size):
        minor = [[plain[r][c] for c in range(size) if c != i] for r in range(size) if r != i]
        spread.append(f"CASE WHEN h{i}{i} >= {LEAST_CURVATURE!r} THEN {_determinant(minor)} / {_determinant(plain)} END AS e{i}")
    return f"""
fit AS (SELECT 0 AS k, {', '.join(f'{start!r}::DOUBLE AS {t}' for t in places)}
        UNION ALL
        SELECT k + 1, {', '.join(f'best.{t}' for t in places)}
        FROM (SELECT k, arg_min({{{packed}}}, f) AS best FROM {tried} WHERE k < {ROUNDS} AND isfinite(f) GROUP BY k)),
fitted AS (SELECT {', '.join(places)}, {', '.join(spread)}
           FROM {_derivatives(f'(SELECT * FROM fit WHERE k = {ROUNDS})', size, row, rows, penalizer)})"""
