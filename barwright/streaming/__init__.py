"""The same steps on Structured Streaming."""
