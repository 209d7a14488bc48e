"""Column functions. All are native expressions: no Python runs on the executors."""
