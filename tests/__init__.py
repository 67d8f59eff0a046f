"""Tests of the library."""
