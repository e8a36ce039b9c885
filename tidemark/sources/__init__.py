"""Table readers, file inventories and sinks."""
