"""Reading and writing: warehouse tables, stored summaries, branches, test data."""
