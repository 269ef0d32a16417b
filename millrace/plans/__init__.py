"""Layers of the engine, each a pure function of DataFrames: bronze, silver, ledger, inventory, gold."""
