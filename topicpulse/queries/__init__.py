"""Named queries on the shared tables and the SQL that checks them."""

from topicpulse.queries.catalog import QUERIES
from topicpulse.queries.oracle import ORACLE

__all__ = ["QUERIES", "ORACLE"]
