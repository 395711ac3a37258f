"""Where rows come from: event streams, landing files, feeds and the base tables."""
