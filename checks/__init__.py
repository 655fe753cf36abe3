"""Queries over the driver tables, each with the SQL it must agree with."""

from checks import analytic_queries, column_queries, document_queries, io_queries, relation_queries
from checks.registry import ORACLES, QUERIES
