"""Structured Streaming: keyed state, micro-batch sinks, the running job."""
