"""Structured Streaming versions of the bronze, silver and gold jobs."""
