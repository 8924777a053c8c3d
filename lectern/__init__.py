"""Content curation and sequence analytics as DataFrame operators."""
