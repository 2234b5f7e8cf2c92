"""The batch stages driven by Structured Streaming."""
