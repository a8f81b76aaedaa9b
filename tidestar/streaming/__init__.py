"""Change files as a stream."""
