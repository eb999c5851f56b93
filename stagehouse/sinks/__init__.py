"""Where rows go: staging, change log, snapshots and marts."""
