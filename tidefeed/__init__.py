"""Change-data capture and analytics over transaction journals, on Spark."""
