"""Readers, file manifests, writers and materialised results."""
