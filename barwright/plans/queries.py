"""The query set: imports every module that registers queries."""

from barwright.plans import catalog  # noqa: F401
from barwright.plans import q_features  # noqa: F401
from barwright.plans import q_indicators  # noqa: F401
from barwright.plans import q_history  # noqa: F401
from barwright.plans import q_universe  # noqa: F401
from barwright.plans import q_runs  # noqa: F401
from barwright.plans import q_quality  # noqa: F401
from barwright.plans import q_io  # noqa: F401
from barwright.plans import q_reports  # noqa: F401
from barwright.plans import q_maintenance  # noqa: F401

QUERIES = catalog.QUERIES
