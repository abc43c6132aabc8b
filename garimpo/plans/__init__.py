"""Registered queries over the driver's tables."""
from garimpo.plans import flow, linking, scalars, stats  # noqa: F401
