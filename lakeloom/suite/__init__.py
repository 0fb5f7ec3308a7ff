"""All registered queries, one module per part of the operator inventory."""

from lakeloom.suite import (  # noqa: F401
    functions, joins_aggregates, learning, quality_rules, relational, sources_sinks, streams, table_changes,
    whole_flows,
)
from lakeloom.suite.base import ORACLE, QUERIES  # noqa: F401
