"""Queries over the driver tables: one or more per operator, each with the SQL that must agree with it."""

from workload.registry import REGISTRY  # noqa: F401
from workload import columns, enrichment, joining, marts, rules, scans, selection, streams, totals  # noqa: F401
