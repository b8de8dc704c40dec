"""Column expressions (no UDFs)."""

from touchline.functions import ordering, text  # noqa: F401
