"""Structured Streaming: sources, the pricing micro-batch job and its sinks."""
