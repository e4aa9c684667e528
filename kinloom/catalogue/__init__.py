"""Named queries over the driver tables, each with its SQL counterpart."""

from .registry import QUERIES, SQL, Source, load_all

__all__ = ["QUERIES", "SQL", "Source", "load_all"]
