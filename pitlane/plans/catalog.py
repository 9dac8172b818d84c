"""Imports every plan module so that all queries are registered."""

from pitlane.plans import q_pit  # noqa: F401
from pitlane.plans import q_reshape  # noqa: F401
from pitlane.plans import q_joins  # noqa: F401
from pitlane.plans import q_upsert  # noqa: F401
from pitlane.plans import q_agg  # noqa: F401
from pitlane.plans import q_rank  # noqa: F401
from pitlane.plans import q_features  # noqa: F401
from pitlane.plans import q_eval  # noqa: F401
from pitlane.plans import q_sources  # noqa: F401
from pitlane.plans import q_ml  # noqa: F401
from pitlane.plans import q_stream  # noqa: F401
