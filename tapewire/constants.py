"""Fixed values that results depend on. Each list is plain text in its natural order."""

# Headers accepted for the ticker column, first present wins.
TICKER_ALIASES = ["ticker", "stock_ticker", "symbol", "topic", "asset", "name"]
# The shorter list that the vote accepts; none of them is an error.
VOTE_TICKER_ALIASES = ["ticker", "stock_ticker", "symbol", "topic"]

# The covered sectors (sector_id is the 1-based position) and their tickers.
SECTOR_TICKERS = {
    "technology": ["MSFT", "AAPL", "NVDA", "GOOGL", "AVGO"],
    "health": ["LLY", "JNJ", "UNH", "MRK", "ABBV"],
    "business": ["BRK.B", "JPM", "V", "BAC", "MA"],
    "science": ["TMO", "AMGN", "GILD", "REGN", "VRTX"],
    "entertainment": ["DIS", "NFLX", "CMCSA", "WBD", "EA"],
}

# Characters a transformer model reads.
IMPACT_MODEL_CHARS = 2000
VOTE_MODEL_CHARS = 4000
# Fixed value: length of the report's top list.
TOP_ARTICLES_DEFAULT = 5

# Sites of user-generated content.
UGC_SITES = [
    "wikipedia.org",
    "wikihow.com",
    "fandom.com",
    "reddit.com",
    "quora.com",
    "stackexchange.com",
    "stackoverflow.com",
    "wikia.org",
    "miraheze.org",
    "archive.org",
    "tvtropes.org",
]
# Page phrases that mark user-generated content, any letter case.
UGC_PHRASES = [
    "MediaWiki",
    "View history",
    "Edit this page",
    "Contribute",
    "User:",
    "Talk:",
    "Post reply",
    "comments-section",
    "Discussion",
]
# Trusted names, matched as plain substrings of the address.
TRUSTED_SOURCES = [
    "bbc.com",
    "nytimes.com",
    "reuters.com",
    "theguardian.com",
    "bloomberg.com",
    "apnews.com",
    "washingtonpost.com",
    "ft.com",
    "cnbc.com",
]
# Endings of institutional and of commercial registered domains.
INSTITUTION_ENDINGS = [".gov", ".edu", ".mil", ".org", ".gov.sg"]
COMMERCIAL_ENDINGS = [".com", ".co", ".net"]
# Status codes that count as reachable, and the feature weights.
REACHABLE_STATUS = [200, 301, 302, 403]
FEATURE_WEIGHTS = {
    "domain_valid": 0.10,
    "https": 0.10,
    "status": 0.15,
    "response_time": 0.10,
    "domain_age": 0.35,
    "neutrality": 0.05,
    "text_len": 0.05,
    "ugc_score": -0.30,
}

# Common public suffixes of more than one label, not all there are. A suffix of
# one label needs no entry: a host that ends in none of these has its last label as the suffix.
COMPOUND_SUFFIXES = [
    "ac.uk", "co.uk", "gov.uk", "ltd.uk", "me.uk", "net.uk", "nhs.uk", "org.uk", "plc.uk",
    "com.au", "edu.au", "gov.au", "net.au", "org.au",
    "ac.nz", "co.nz", "govt.nz", "net.nz", "org.nz",
    "com.sg", "edu.sg", "gov.sg", "net.sg", "org.sg",
    "com.my", "edu.my", "gov.my", "org.my",
    "com.hk", "edu.hk", "gov.hk", "org.hk",
    "com.cn", "edu.cn", "gov.cn", "net.cn", "org.cn",
    "com.tw", "edu.tw", "gov.tw", "org.tw",
    "ac.jp", "co.jp", "go.jp", "ne.jp", "or.jp",
    "ac.kr", "co.kr", "go.kr", "or.kr",
    "ac.in", "co.in", "gov.in", "net.in", "org.in",
    "ac.id", "co.id", "go.id", "or.id",
    "ac.th", "co.th", "go.th", "or.th",
    "com.ph", "gov.ph", "com.vn", "gov.vn",
    "com.br", "gov.br", "net.br", "org.br",
    "com.mx", "gob.mx", "org.mx", "com.ar", "gob.ar",
    "ac.za", "co.za", "gov.za", "org.za",
    "ac.il", "co.il", "gov.il", "org.il",
    "com.tr", "edu.tr", "gov.tr",
]

# A small finance word list for the built-in scorer.
FINANCE_POSITIVE = [
    "advance", "advances", "beat", "beats", "boost", "boosts", "bullish", "climb", "climbs",
    "expand", "expands", "gain", "gains", "growth", "improve", "improved", "improves",
    "jump", "jumps", "outperform", "outperforms", "profit", "profits", "rally", "rallies",
    "rebound", "record", "rise", "rises", "soar", "soars", "strong", "surge", "surges",
    "upgrade", "upgraded", "win", "wins",
]
FINANCE_NEGATIVE = [
    "bankruptcy", "bearish", "crash", "crashes", "cut", "cuts", "decline", "declines",
    "default", "downgrade", "downgraded", "drop", "drops", "fall", "falls", "fine", "fraud",
    "lawsuit", "layoff", "layoffs", "loss", "losses", "miss", "misses", "plunge", "plunges",
    "probe", "recall", "recession", "sink", "sinks", "slump", "slumps", "tumble", "tumbles",
    "warn", "warning", "weak",
]
