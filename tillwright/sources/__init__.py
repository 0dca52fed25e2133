"""Inputs: driver tables, dimensions, the ledger and the event topic."""
