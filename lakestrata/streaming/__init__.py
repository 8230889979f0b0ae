"""The landing and current-state steps fed by Structured Streaming."""
