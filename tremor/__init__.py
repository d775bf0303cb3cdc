"""A PySpark-native engine for machine condition-monitoring data."""

__version__ = "0.2.0"


def producer_name() -> str:
    """Who made a document: for its provenance."""
    return f"tremor {__version__}"
