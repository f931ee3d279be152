"""Reading landed raw files and tables, and writing results."""
