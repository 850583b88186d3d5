"""Reading and writing: raw files, catalogs, exports."""
