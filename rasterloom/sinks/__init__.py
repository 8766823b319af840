"""Sinks: tiled TIFF rasters, PNG previews, quality report, catalogue item."""
