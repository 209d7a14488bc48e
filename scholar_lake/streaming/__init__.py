"""Run-to-completion streams over new snapshot files."""
