"""Compositions of operators: gene-family analyses and the queries on the benchmark tables."""
