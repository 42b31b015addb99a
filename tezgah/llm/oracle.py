"""Expected results in DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}
