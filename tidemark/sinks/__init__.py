"""Writers for label feeds, dimensions and partitioned tables."""
