"""Column functions: everything here maps ``Column`` to ``Column``, row by row."""
