from quotebook.sources import api, book, cards, detail, listings, priority  # noqa: F401
