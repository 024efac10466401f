from quotebook.functions import names, text, vocabulary  # noqa: F401
