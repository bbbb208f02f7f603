"""Query plans: staged inputs over the driver tables, the registered
queries, their SQL oracles and the end-to-end layer job."""
