"""Local-events data engine on Spark."""
