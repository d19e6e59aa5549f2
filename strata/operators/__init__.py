"""Pattern operators: pure DataFrame -> DataFrame functions."""
