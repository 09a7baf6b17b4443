"""SQL that computes the same rows as the subpackage's queries."""

SQL: dict[str, str] = {}
