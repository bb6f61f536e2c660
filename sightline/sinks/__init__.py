"""Table, document and message sinks."""
