"""Column-level building blocks: text cleaning and array-vector arithmetic."""
