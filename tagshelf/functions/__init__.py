"""Column expressions, and the little that tasks compute with arrays (``blocks``)."""
