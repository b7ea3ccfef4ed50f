"""Composed jobs: gold scoring, silver typing/merges, incremental runner,
snapshot landing.  Pure plan builders return DataFrames; ``run_*`` functions
perform the writes."""
