"""The driver's test tables bound to the sales contract, with queries and oracles."""
