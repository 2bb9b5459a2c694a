"""Readers, landing, stand-in inputs and the shared-folder table store."""
