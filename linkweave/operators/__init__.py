"""DataFrame-in, DataFrame-out building blocks."""
