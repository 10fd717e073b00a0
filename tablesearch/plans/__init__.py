"""All registered queries."""

from . import changes, filters, relational, search, streams, tpch  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
