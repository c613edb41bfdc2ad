"""The daily run over arriving files, as Structured Streaming."""
