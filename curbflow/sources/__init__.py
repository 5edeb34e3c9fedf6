"""Where rows come from: stored fleet tables, ping batches, and tables derived from an event log."""
