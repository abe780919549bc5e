"""Import every query module so the registry is complete."""

from fleetlens.plans import queries_core  # noqa: F401
from fleetlens.plans import queries_da  # noqa: F401
from fleetlens.plans import queries_signal  # noqa: F401
from fleetlens.plans import queries_features  # noqa: F401
from fleetlens.plans import queries_sinks  # noqa: F401
from fleetlens.plans import queries_ml  # noqa: F401
from fleetlens.plans import queries_models  # noqa: F401
