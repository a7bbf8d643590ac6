"""File readers, table loads, catalog queries and sinks."""
