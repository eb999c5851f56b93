"""Where rows come from: relational snapshots and XML files."""
