"""Where rows go: warehouse tables, reports, compacted folders."""
