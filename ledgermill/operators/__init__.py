"""DataFrame-in, DataFrame-out building blocks of the warehouse."""
