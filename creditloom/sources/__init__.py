"""Readers, writers and the adapters that give tables their loan-domain roles."""
