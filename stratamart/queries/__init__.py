"""Every operator as a runnable query over the star-schema tables, with an independent SQL check."""

from .registry import REGISTRY, oracles, runners  # noqa: F401
from . import pipeline, relational, scalars, metadata, writes, streams, findings  # noqa: F401
