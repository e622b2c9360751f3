"""Readers for landed feeds and stores, and the writers that publish results."""
