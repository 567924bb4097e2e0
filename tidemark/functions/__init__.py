"""Column-level building blocks: types, casts, time, encryption."""
