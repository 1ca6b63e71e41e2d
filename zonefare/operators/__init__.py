"""DataFrame operators: each takes and returns DataFrames, static or streaming."""
