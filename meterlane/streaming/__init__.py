"""Structured Streaming: each transformation is a plain DataFrame function, so the
same body runs on a finished table and on a stream."""
