"""Relational operators. Each takes DataFrames plus explicit parameters
(``as_of``, ``zone``, bounds) and returns a lazy DataFrame."""
