"""Readers and writers. Connections and paths are always arguments."""
