"""Raw readers, view registration and table writes."""
