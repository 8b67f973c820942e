"""Where rows come from: streams, lake tables, reference tables, the rule catalogue."""
