"""Where rows come from: the registry of entities, tables, buffer files and calls."""
