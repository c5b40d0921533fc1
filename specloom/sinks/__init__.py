"""Writers: content-addressed blobs, CSV, JSON lines, packages with checksums."""
