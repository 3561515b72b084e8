"""Graph operators: each takes DataFrames/graphs and returns DataFrames/graphs."""
