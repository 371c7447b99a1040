"""DataFrame to DataFrame operators, lazy and generic in their columns."""
