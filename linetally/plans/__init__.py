"""Reports: each function takes tables and an as-of date and returns a sorted DataFrame."""
