"""Sources: acquisition packages and TIFF rasters."""
