"""Writing results: warehouse tables, JDBC targets, JSON files, views and models."""
