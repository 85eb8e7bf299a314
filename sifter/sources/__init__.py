"""Sources and sinks (A1-A5) and the bindings to the driver tables."""
