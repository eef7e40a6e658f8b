"""The warehouse jobs as Structured Streaming queries."""
