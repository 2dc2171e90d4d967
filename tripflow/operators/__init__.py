"""DataFrame-to-DataFrame operators; none of them does I/O."""
