"""Named queries, their reference SQL, and the SQL way in."""
