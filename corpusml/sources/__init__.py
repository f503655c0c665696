"""Text sources and sinks."""
