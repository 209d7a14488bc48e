"""Reading snapshots: entity files, merge lists, and validation of what was read."""
