"""Rules and labelled URLs that the registered URL filter is given."""

# Host and path rules with their verdicts.
URL_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)

# Host names of sites nobody wants in a training set.
BLOCKED_SITES = (
    "ads-network", "ads-server", "adult-dating", "adult-video", "adult-zone", "banner-ads",
    "bet-online", "bets-today", "casino-bonus", "casino-online", "casino-slots", "cheap-loans",
    "cheap-meds", "cheap-viagra", "click-farm", "click-tracker", "crack-serial", "diet-pills",
    "free-casino", "free-adult", "free-spins", "free-xxx", "hot-singles", "keygen-crack",
    "link-farm", "live-bets", "lotto-win", "online-pills", "payday-loan", "pills-shop",
    "poker-win", "porn-tube", "seo-spam", "sex-cams", "spam-links", "spam-mail", "sports-bets",
    "track-pixel", "user-track", "viagra-pills", "warez-free", "win-prize", "win-cash", "xxx-adult",
)

# Host names of ordinary sites.
ALLOWED_SITES = (
    "anderson", "archive", "astronomy", "bibliothek", "bookshop", "botanik", "brighton",
    "cathedral", "chemistry", "cinema", "cuisine", "culture", "docs", "einstein", "escuela",
    "forest", "forum", "gallery", "garden", "geschichte", "gesundheit", "granada", "harbour",
    "health", "history", "hospital", "institute", "journal", "kitchen", "landscape", "lehrer",
    "library", "literature", "london", "mathematics", "montagne", "mountain", "museum", "musique",
    "nature", "news", "northern", "observatory", "orchestra", "painting", "philosophy", "physics",
    "poetry", "recipes", "research", "revista", "river", "school", "science", "stations", "studio",
    "teacher", "theatre", "tinder", "travel", "university", "verein", "weather", "wissenschaft",
    "workshop", "writing", "zeitung", "ringing", "thinking", "reading", "hearing", "nation",
)
