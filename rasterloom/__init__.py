"""Spark-native calibration, quality and preview engine for line-scan imagery."""

from importlib import metadata


def _version() -> str:
    """That of the installed distribution; a checkout that is not installed says so."""
    try:
        return metadata.version("rasterloom")
    except metadata.PackageNotFoundError:
        return "0.0.0+source"


__version__ = _version()
