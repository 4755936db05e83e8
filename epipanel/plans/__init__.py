"""Feature sets and multi-step plans built from operators."""
