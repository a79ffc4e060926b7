"""Native scalar expressions and fixed lookup values."""
from . import lookups, scalars  # noqa: F401
