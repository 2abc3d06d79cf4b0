"""Incremental (Structured Streaming) execution of the resampling job."""
