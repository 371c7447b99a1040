"""Reading and writing: landed snapshots, the raw lake, the warehouse tables."""
