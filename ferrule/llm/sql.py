"""SQL of the same results, where SQL can express them."""

SQL: dict[str, str] = {}
