"""All registered queries. Importing a module registers what it holds."""

from tidewell.plans import batch_core, batch_quality_cdc, batch_science, batch_windows, event_streams, functions_io, streams  # noqa: F401
from tidewell.plans.registry import ORACLES, QUERIES  # noqa: F401
