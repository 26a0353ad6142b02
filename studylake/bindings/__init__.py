"""The driver's tables in the role of the learning tables."""
