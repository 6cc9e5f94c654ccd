"""Reading nested telemetry (OTLP as JSON)."""
