"""Writers: lakehouse tables, staged files with a manifest, JDBC tables."""
