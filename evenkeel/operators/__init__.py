"""Table-level operators: comparisons, loads, slices, checks, tallies, run summaries."""
