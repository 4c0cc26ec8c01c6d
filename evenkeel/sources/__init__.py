"""Where data comes from and goes to: seeds, versioned tables, logs, archived run results."""
