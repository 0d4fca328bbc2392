"""Where rows come from and go to: messages, streams, tables and dimensions."""
