"""Writing: the lake's tables, CSV and JSON exports, the search index, and an optional JDBC load."""
