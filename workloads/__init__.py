from . import layout, movement, recon_runs, state, streams, verification  # noqa: F401
from .registry import oracles, registered

__all__ = ["oracles", "registered"]
