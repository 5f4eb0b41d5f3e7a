"""Trip sources: declared schema, fixture trips, CSV scans and file positions."""
