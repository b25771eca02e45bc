"""Assembles oracle SQL text for DuckDB from named CTE bodies.

Each oracle query is ``WITH <needed CTEs in dependency order> <final select>``;
the registered driver tables (``events``, ``documents`` ...) are read directly.
"""

from __future__ import annotations

US_PER_SECOND = 1_000_000
US_PER_HOUR = 3_600 * US_PER_SECOND


class SqlBook:
    def __init__(self) -> None:
        self.ctes: dict[str, tuple[tuple[str, ...], str]] = {}

    def add(self, name: str, deps: tuple[str, ...] | list[str], body: str) -> None:
        self.ctes[name] = (tuple(deps), body)

    def update(self, ctes: dict[str, tuple[tuple[str, ...], str]]) -> None:
        self.ctes.update(ctes)

    def _order(self, roots: list[str]) -> list[str]:
        seen: list[str] = []
        visiting: set[str] = set()

        def visit(n: str) -> None:
            if n in seen:
                return
            if n in visiting:
                raise ValueError(f"cycle at {n}")
            visiting.add(n)
            for d in self.ctes[n][0]:
                visit(d)
            visiting.discard(n)
            seen.append(n)

        for r in roots:
            visit(r)
        return seen

    def sql(self, final: str, deps: list[str] | tuple[str, ...]) -> str:
        names = self._order(list(deps))
        parts = [f"{n} AS ({self.ctes[n][1]}\n)" for n in names]
        return "WITH " + ",\n".join(parts) + "\n" + final


def us_between(start: str, end: str) -> str:
    return f"(epoch_us({end}) - epoch_us({start}))"


# -- tables of constants and step functions ---------------------------------------------

def ids(text: str) -> str:
    """'1 2 3' -> '1, 2, 3'."""
    return ", ".join(text.split())


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def table(columns: str, rows) -> str:
    """A VALUES table with named columns, to be used in FROM."""
    def cell(x) -> str:
        if x is None:
            return "NULL"
        if isinstance(x, bool):
            return str(x).upper()
        return quoted([x]) if isinstance(x, str) else repr(x)
    body = ", ".join("(" + ", ".join(cell(x) for x in r) + ")" for r in rows)
    return f"(VALUES {body}) AS {columns}"


def steps(x: str, edges, points) -> str:
    """Points of the band that x lies in: a list of points, indexed by the edges x has reached."""
    reached = " + ".join(f"CAST({x} >= {e} AS INTEGER)" for e in edges)
    values = ", ".join("NULL" if p is None else str(p) for p in points)
    return f"list_extract(CAST([{values}] AS INTEGER[]), 1 + {reached})"


def yes(cond: str) -> str:
    """1 where the condition holds, else 0 (also where it is unknown)."""
    return f"CAST(coalesce({cond}, FALSE) AS INTEGER)"


def day_buckets() -> str:
    """(style, day, low, high): offsets in microseconds, both ends included."""
    hour, second = US_PER_HOUR, US_PER_SECOND
    rows = []
    for style, width, n in (("open", 24, 7), ("half_mixed", 24, 7), ("closed_hi", 24, 7), ("bili", 24, 7),
                            ("h24", 24, 7), ("h24_late", 24, 7), ("h12", 12, 14), ("h6", 6, 28)):
        for day in range(1, n + 1):
            low, high = (day - 1) * width * hour, day * width * hour
            if day == 1:
                low = -(1 << 62)
                high += second if style == "h24_late" else 0
            elif style in ("open", "closed_hi") or day > 5 and style in ("half_mixed", "bili"):
                low += second + 1
            elif style in ("half_mixed", "bili"):
                low += 1
            else:
                low += second + (style == "h24_late" and day == 2)
            if day > 1 and style in ("open", "half_mixed"):
                high -= 1
            rows.append((style, day, low, high))
    return f"SELECT * FROM {table('t(style, day, low, high)', rows)}"


def bucket_join(alias: str, style: str, delta: str, kind: str = "JOIN") -> str:
    return f"{kind} day_buckets {alias} ON {alias}.style = {style} AND {delta} BETWEEN {alias}.low AND {alias}.high"
