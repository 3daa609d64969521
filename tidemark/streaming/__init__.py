"""State, sinks and Structured Streaming around the operators."""
