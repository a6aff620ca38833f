"""Registered queries: importing this package fills the registry."""

from panelkit.plans import forecasting, inference, learning, preparation, profiling, text  # noqa: F401
from panelkit.plans.registry import ORACLES, QUERIES  # noqa: F401
