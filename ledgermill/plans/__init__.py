"""The batch pipeline over written layers."""
