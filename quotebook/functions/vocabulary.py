"""Fixed word lists of the matching rules. The values decide the results, so they are kept as data."""

# Words without identity at the end of a company name.
TRAILING_WORDS = (
    "limited", "ltd", "unlisted", "share", "shares", "private", "pvt", "inc",
    "company", "co", "price", "online", "buy", "sell",
)

# Tokens never used for matching (the trailing words and four more).
STOP_TOKENS = TRAILING_WORDS + ("the", "of", "and", "india")

# Industry words.
GENERIC_TOKENS = (
    "electric", "energy", "finance", "financial", "hospital", "steel", "power", "green",
    "tech", "technologies", "technology", "industries", "industry", "international", "bank",
    "insurance", "services", "service", "solutions", "solution", "holdings", "holding",
    "investment", "investments", "capital", "general", "health", "life", "renewable",
    "renewables", "infra", "market", "home", "housing", "exchange", "stock", "share",
    "equity", "fund", "mutual", "research", "clinical", "consumer", "ventures", "venture",
)

# Tokens that describe a company but do not identify it.
DESCRIPTOR_TOKENS = GENERIC_TOKENS + (
    "software", "tool", "lab", "ent", "product", "system", "president", "series", "ccp",
    "ccps", "esop", "formerly", "known", "previous", "previously",
)

# Substrings removed from a match key, in this order.
KEY_NOISE = ("limited", "ltd", "unlisted", "shares", "share", "private", "pvt", "inc", "company", "co")

# Match tiers and thresholds.
TIER_EQUAL = 95
TIER_SUBSET = 88
TIER_SHORT = 82
TIER_OVERLAP = 70
MIN_OVERLAP = 0.72
AMBIGUITY_GAP = 0.2
MIN_IDENTITY_LENGTH = 4
