"""tidewater — Spark-native lakehouse, telemetry and governance operators.

Every operator is a pure ``DataFrame -> DataFrame`` function built from
Catalyst built-ins so batch and Structured Streaming share the same code.
"""

__version__ = "0.1.0"
