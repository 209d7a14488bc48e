"""scholar_lake: dated snapshots of nested scholarly metadata as Spark tables, kept current and searchable."""
