"""Readers and writers of device logs, manifests and ledgers."""
