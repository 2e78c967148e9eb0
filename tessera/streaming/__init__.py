"""Event tables: parsing, cleaning, rollups and alerts for batch and stream, and stream writers."""
