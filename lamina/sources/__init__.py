"""Reading and writing tables of the layers."""
