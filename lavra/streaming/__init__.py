"""Event decoding, validation and stream ingestion."""
