"""Every operator and job as a query on the given tables, with the SQL that checks it."""

from . import (aggregates, columns, conditions, filters, jobs, joins, reshaping, sinks, sources,  # noqa: F401
               strings, windows)
from .registry import QUERIES, SQL  # noqa: F401
