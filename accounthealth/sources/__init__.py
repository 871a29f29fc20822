"""Raw source readers (driver parquet bindings, CSV) and sinks."""
