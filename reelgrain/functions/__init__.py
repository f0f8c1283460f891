"""Column functions: paths and keys, times, numbers and flags."""
