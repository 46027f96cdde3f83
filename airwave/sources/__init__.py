"""Sources: landed API pages, snapshot tables, and the mapping from test events."""
