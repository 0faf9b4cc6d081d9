"""Where rows come from: raw CSV groups, event streams, sample tables."""
