"""Conditions that cut a database table into parts for a parallel read.

A range of a number or date is cut by Spark itself. Text columns, and columns whose values pile up, are cut here: by a hash
that the database computes, or between bounds with equally many rows on either side, which the database is asked for. Every
row, those with nulls included, fulfils exactly one of the conditions.
"""

from __future__ import annotations

from collections.abc import Sequence

# A whole number from 0 that each kind of database makes of a value; {c} is the column, {n} the parts.
HASHES = {
    "postgresql": "mod(hashtext(cast({c} as text))::bigint + 2147483648, {n})",
    "mysql": "mod(crc32({c}), {n})",
    "mariadb": "mod(crc32({c}), {n})",
    "oracle": "ora_hash({c}, {n} - 1)",
    "sqlserver": "(cast(checksum({c}) as bigint) + 2147483648) % {n}",
}


def dialect(url: str) -> str:
    """The kind of database that a JDBC address names."""
    parts = url.split(":")
    return parts[1].lower() if len(parts) > 2 and parts[0].lower() == "jdbc" else ""


def quoted_value(value: object) -> str:
    """A value as SQL: numbers as they are, all else as text."""
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        return "'" + str(value).replace("'", "''") + "'"
    return repr(value)


def hash_predicates(url: str, column: str, parts: int) -> list[str]:
    """One condition per part: rows whose value has that hash; nulls are in the first part.

    A value stands in one part, so a column in which one value holds most rows needs the bounds of another column.
    """
    kind = dialect(url)
    if kind not in HASHES:
        raise ValueError(f"no hash is known for databases of kind {kind!r}; known are {sorted(HASHES)}")
    if parts < 2:
        return ["1 = 1"]
    hashed = HASHES[kind].format(c=column, n=parts)
    # Some databases have a hash for null as well.
    first = f"{column} IS NULL OR {hashed} = 0"
    return [first, *[f"{column} IS NOT NULL AND {hashed} = {k}" for k in range(1, parts)]]


def bounds_question(table: str, column: str, parts: int) -> str:
    """SQL for the least value of each of ``parts`` runs with equally many rows."""
    return (
        f"SELECT min(v) AS low FROM (SELECT {column} AS v, ntile({parts}) OVER (ORDER BY {column}) AS part "
        f"FROM {table} WHERE {column} IS NOT NULL) runs GROUP BY part ORDER BY low"
    )


def bound_predicates(column: str, lows: Sequence[object]) -> list[str]:
    """One condition per part between the least values of the parts, in order; the ends are open and nulls go first.

    Equal bounds, as of a value that fills several parts, are one bound: no part is empty by design.
    """
    cuts = sorted({low for low in lows if low is not None})[1:]
    if not cuts:
        return ["1 = 1"]
    texts = [quoted_value(c) for c in cuts]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(texts, texts[1:])]
    return [f"{column} < {texts[0]} OR {column} IS NULL", *middle, f"{column} >= {texts[-1]}"]
