"""Quoting of column names inside SQL expression text."""


def quote(name: str) -> str:
    """A column name as a SQL identifier: ``a b`` → ```a b```."""
    return "`" + name.replace("`", "``") + "`"
