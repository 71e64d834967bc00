"""Plans: user SQL, SQL model sets, declared-table refresh and end-to-end pipelines."""
