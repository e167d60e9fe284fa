"""Writers of the tables."""
