"""DataFrame-to-DataFrame business operators."""
