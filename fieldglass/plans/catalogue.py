"""All registered queries."""

from fieldglass.plans import merging, models, seasons, service, streams, windows  # noqa: F401  registers them
from fieldglass.plans.registry import ORACLE_SQL, QUERIES  # noqa: F401
