"""DataFrame-to-DataFrame operators; none of them knows about a particular table."""
