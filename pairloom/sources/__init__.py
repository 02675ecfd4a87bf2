"""Readers, writers, versioned tables and the feature-view registry."""
