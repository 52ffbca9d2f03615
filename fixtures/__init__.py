"""Banking staging views over the driver's star-schema tables, and their oracles."""
