"""Import every operator module so that the registry is complete."""

from fleetlens.llm import capfilters  # noqa: F401
from fleetlens.llm import extraction  # noqa: F401
from fleetlens.llm import ffd  # noqa: F401
from fleetlens.llm import fingerprint  # noqa: F401
from fleetlens.llm import importance  # noqa: F401
from fleetlens.llm import mixing  # noqa: F401
from fleetlens.llm import minhash  # noqa: F401
from fleetlens.llm import packing  # noqa: F401
from fleetlens.llm import pseudonyms  # noqa: F401
from fleetlens.llm import quality  # noqa: F401
from fleetlens.llm import secret_scan  # noqa: F401
from fleetlens.llm import suffixes  # noqa: F401
from fleetlens.llm import whitening  # noqa: F401
from fleetlens.llm.common import ORACLE, QUERIES  # noqa: F401
