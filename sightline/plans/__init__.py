"""Ready-made queries over the driver's tables, each with the SQL that must give the same rows."""

from sightline.plans import lookups, scans, storage, streams, timeline, transforms, upkeep  # noqa: F401
from sightline.plans.registry import ORACLES, QUERIES  # noqa: F401
