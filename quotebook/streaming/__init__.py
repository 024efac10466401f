from quotebook.streaming import feed, upsert  # noqa: F401
