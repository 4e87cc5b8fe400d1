"""Sources and sinks: CSV readings, JDBC tables, small frame utilities."""
