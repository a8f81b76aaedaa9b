"""Plans over whole batches and tables: star assembly, warehouse, reports."""
