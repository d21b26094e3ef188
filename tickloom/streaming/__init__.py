"""The same merges and aggregates driven by Structured Streaming."""
