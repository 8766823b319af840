"""DataFrame operators: timing, interpolation, calibration, quality, previews, reflectance."""
