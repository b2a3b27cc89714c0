"""Demo queries over the driver tables, one per operator key, with DuckDB oracles."""

from ferry.demos import choosing, landing, relational

QUERIES: dict = {**landing.Q, **choosing.Q, **relational.Q}
ORACLES: dict[str, str] = {**landing.SQL, **choosing.SQL, **relational.SQL}

__all__ = ["QUERIES", "ORACLES"]
