"""Registered queries on the test tables, their SQL, and the inputs both sides share."""

from checks import columns, metrics, reports, samples, scans  # noqa: F401  (they register their queries)
from checks.registry import ORACLES, QUERIES  # noqa: F401
