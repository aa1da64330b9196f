"""DataFrame-to-DataFrame operators; none of them knows the test tables."""
