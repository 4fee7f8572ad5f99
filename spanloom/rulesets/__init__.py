"""Rule sets: patterns by kind of entity, for German clinical text."""
