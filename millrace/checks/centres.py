"""SQL of the fitted clusterings: farthest-first seeds, then one Lloyd round per recursion."""

from __future__ import annotations

from millrace.operators.clustering import ROUNDS, TOLERANCE


def _square(a: str, b: str, size: int) -> str:
    return " + ".join(f"({a}[{i}] - {b}[{i}]) * ({a}[{i}] - {b}[{i}])" for i in range(1, size + 1))


def _rounds(name: str, start: str, points: str, key: str, size: int) -> str:
    """Recursive part (key, round, centres, moved, most): all keys go on until none moves."""
    means = ", ".join(f"avg(x[{i}])" for i in range(1, size + 1))
    return f"""{name} AS (
  SELECT {key}, 0 AS round, centres, 1e300::DOUBLE AS moved, 1e300::DOUBLE AS most FROM {start}
  UNION ALL
  SELECT {key}, round + 1, centres, moved, max(moved) OVER () FROM (
    SELECT {key}, round, next AS centres, list_max(list_transform(next, lambda c, j: {_square('c', 'centres[j]', size)})) AS moved FROM (
      SELECT {key}, round, centres, list_transform(centres, lambda c, j: coalesce(found[j], c)) AS next FROM (
        SELECT {key}, round, centres, map_from_entries(list((cluster, mean))) AS found FROM (
          SELECT {key}, round, centres, cluster, [{means}] AS mean FROM (
            SELECT {key}, round, centres, x, list_position(d, list_min(d)) AS cluster FROM (
              SELECT {key}, round, centres, x, list_transform(centres, lambda c: {_square('x', 'c', size)}) AS d
              FROM {name} JOIN {points} USING ({key}) WHERE most > {TOLERANCE!r} AND round < {ROUNDS}))
          GROUP BY ALL) GROUP BY ALL))))"""


def fitted(name: str, points: str, k: int, size: int) -> list[str]:
    """Parts that end in ``{name}``: (centres in coordinate order, cost, rounds, converged) of the rows ``x`` of ``points``."""
    mean = "[" + ", ".join(f"avg(x[{i}])" for i in range(1, size + 1)) + "]"
    return [
        f"{name}_points AS MATERIALIZED (SELECT 1 AS one, x FROM {points})",
        f"""{name}_seeds AS (
  SELECT 1 AS i, [first(x ORDER BY {_square('x', 'm', size)}, x)] AS centres FROM {name}_points, (SELECT {mean} AS m FROM {name}_points)
  UNION ALL
  SELECT any_value(i) + 1, list_append(any_value(centres), first(x ORDER BY d DESC, x))
  FROM (SELECT i, centres, x, list_min(list_transform(centres, lambda c: {_square('x', 'c', size)})) AS d
        FROM {name}_seeds, {name}_points WHERE i < {k}) HAVING count(*) > 0)""",
        f"{name}_start AS (SELECT 1 AS one, centres FROM {name}_seeds WHERE i = {k})",
        _rounds(f"{name}_rounds", f"{name}_start", f"{name}_points", "one", size),
        f"""{name} AS MATERIALIZED (
  SELECT list_sort(centres) AS centres, rounds, converged,
         (SELECT sum(list_min(list_transform(centres, lambda c: {_square('x', 'c', size)}))) FROM {name}_points) AS cost
  FROM (SELECT arg_max(centres, round) AS centres, max(round) AS rounds, min(most) <= {TOLERANCE!r} AS converged FROM {name}_rounds))""",
    ]


def centre_rows(name: str, columns: list[str], size: int) -> str:
    """One row per centre; columns beyond its size are zero."""
    values = ", ".join((f"centres[i][{j}]" if j <= size else "0.0::DOUBLE") + f" AS {c}" for j, c in enumerate(columns, 1))
    return (
        f"SELECT CAST(i - 1 AS INTEGER) AS cluster, {values}, cost, CAST(rounds AS INTEGER) AS rounds, converged "
        f"FROM {name}, range(1, len(centres) + 1) t(i)"
    )


def keyed(name: str, points: str, start: list[list[float]]) -> list[str]:
    """Parts that end in ``{name}``: (machine_id, centres) of one clustering per machine."""
    centres = "[" + ", ".join("[" + ", ".join(f"{v!r}::DOUBLE" for v in c) + "]" for c in start) + "]"
    return [
        f"{name}_start AS (SELECT DISTINCT machine_id, {centres} AS centres FROM {points})",
        _rounds(f"{name}_rounds", f"{name}_start", points, "machine_id", len(start[0])),
        f"{name} AS MATERIALIZED (SELECT machine_id, arg_max(centres, round) AS centres FROM {name}_rounds GROUP BY 1)",
    ]
