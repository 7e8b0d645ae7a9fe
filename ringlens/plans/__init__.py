"""End-to-end jobs composed from operators, sources and sinks."""
