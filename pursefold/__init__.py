"""Per-user tables from daily payment-app data, kept up to date with Spark."""
