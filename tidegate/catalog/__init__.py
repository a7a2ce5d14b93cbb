from tidegate.catalog import deletes, extracts, graphs, loads, merges  # noqa: F401
from tidegate.catalog.registry import QUERIES, SQL  # noqa: F401
