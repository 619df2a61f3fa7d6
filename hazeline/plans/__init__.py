"""Plan shapes shared by the operators: split series windows and distributed quantiles."""
