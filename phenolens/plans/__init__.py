"""Query definitions over the driver tables, their SQL oracles and the clustering experiment."""
