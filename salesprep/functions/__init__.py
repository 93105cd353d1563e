"""Column to column functions. None of them touches a DataFrame."""
