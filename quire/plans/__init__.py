"""Named queries over the catalog tables."""
