"""Where rows come from and where layers are kept."""
