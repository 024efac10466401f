from quotebook.plans import upsert  # noqa: F401
