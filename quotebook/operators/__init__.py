from quotebook.operators import candidates, listings, merge, publish, resolve  # noqa: F401
