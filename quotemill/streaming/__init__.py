"""Structured Streaming forms of the call-log, checkpoint and load operators."""
