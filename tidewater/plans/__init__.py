"""Composite plans (warehouse, telemetry, quality, governance) and the
registered queries built from them (``q_*`` modules)."""
