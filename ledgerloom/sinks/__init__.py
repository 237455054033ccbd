"""Writers of files and tables."""
