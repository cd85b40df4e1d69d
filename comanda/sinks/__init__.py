"""Writers: warehouse tables, serving store, files."""
