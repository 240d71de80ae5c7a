"""Incremental (Structured Streaming) runs of the batch operators."""
