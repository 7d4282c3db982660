"""The reporting jobs. Each takes its input tables and returns a DataFrame. Building one runs no
job over the data but the counts that find hot groups and checkpoints of small tables."""
