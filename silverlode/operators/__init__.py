"""Table-to-table operators shared by the models."""
