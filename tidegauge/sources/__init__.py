"""Where rows come from: topics, file drops, the lake and registry tables."""
