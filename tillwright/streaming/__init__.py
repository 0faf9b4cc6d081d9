"""Shop events: parsing, routing, windowed counts, serving."""
