"""Sources and sinks: landed tables, feed and search payloads, pages, history."""
