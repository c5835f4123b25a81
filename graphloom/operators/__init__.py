"""Relations, graphs and dictionaries as DataFrame transformations."""
