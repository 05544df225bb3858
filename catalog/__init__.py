"""The engine's operators bound to the driver's test tables, with SQL oracles."""
