"""Flow-record classification analytics as composable PySpark DataFrame operators."""

from flowsift.spec import DEFAULT_SPEC, FlowSpec

__all__ = ["DEFAULT_SPEC", "FlowSpec"]
