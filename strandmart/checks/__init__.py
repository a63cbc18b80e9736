"""Stand-alone queries on the shared test tables, each with its SQL oracle."""

from strandmart.checks import models, relational, rule_checks, scalar, silver_checks, source_checks, upsert_checks  # noqa: F401
from strandmart.checks.registry import ORACLES, QUERIES  # noqa: F401
