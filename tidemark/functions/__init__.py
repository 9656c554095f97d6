"""Column-level building blocks: every function returns a Column or narrows a DataFrame without a shuffle."""
