"""Readers, writers and injectable providers."""
