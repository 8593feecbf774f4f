"""Where rows go: files, topics, databases, line-protocol endpoints."""
