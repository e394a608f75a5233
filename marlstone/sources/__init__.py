"""Reading files, keeping tables, and naming them in a catalog."""
