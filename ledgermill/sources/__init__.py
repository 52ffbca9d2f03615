"""Raw landing files and the written layers."""
