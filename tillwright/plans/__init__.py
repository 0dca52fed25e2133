"""Batch jobs composed from the operators: layer writes, gold publishing, exports."""
