"""The same jobs as Structured Streaming queries over landed files."""
