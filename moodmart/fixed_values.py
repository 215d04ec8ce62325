"""Values fixed by the data contract.

Everything here must be exactly this for results, keys and file names to match what users of the warehouse have today.
Code elsewhere takes these as parameter defaults; nothing else in the package repeats them.
"""

# --- Fixed values -----------------------------------------------------------------------------------------------------

# Feed
FEED_NAME = "epl_news"
FEED_URL = "https://www.bbc.com/sport/football/teams"
PAGES_PER_TEAM = 10
RUN_TIME_ZONE = "Europe/Vienna"
TEAM_NAMES = (
    "AFC Bournemouth",
    "Arsenal",
    "Aston Villa",
    "Brentford",
    "Brighton & Hove Albion",
    "Chelsea",
    "Crystal Palace",
    "Everton",
    "Fulham",
    "Ipswich Town",
    "Leicester City",
    "Liverpool",
    "Manchester City",
    "Manchester United",
    "Newcastle United",
    "Nottingham Forest",
    "Southampton",
    "Tottenham Hotspur",
    "West Ham United",
    "Wolverhampton Wanderers",
)

# What a landed row holds when its page could not be fetched
FETCH_FAILURE = r"^(HTTP error [0-9]+|Failed after [0-9]+ attempts)$"
HTTP_500 = "HTTP error 500"

# Page markup
HEADLINE_CLASS = "ssrcss-189b1h2-HeadlineWrap"
PARAGRAPH_CLASS = "ssrcss-1q0x1qg-Paragraph e1jhz7w10"
TIMESTAMP_TESTID = "timestamp"
TIMESTAMP_TEXT_TESTID = "accessible-timestamp"
NO_DATE = "No date found"
NO_TITLE = "No title found"
NO_CONTENT = "No content found"
DATE_LEAD_IN = "published at "

# Titles
LIVE_COVERAGE_TITLES = (
    r"Catch up on the Premier League action",
    r"Follow (Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday)'s (Premier League games|Carabao Cup)",
    r"Follow\s+([A-Za-z\s]+)\s+v\s+([A-Za-z\s]+)",
    r"who is your team facing\?",
    r"send us your thoughts",
)
NOT_PROFESSIONAL_TITLES = (
    r"Did you know?",
    r"the fans' verdict",
    r"Gossip",
)
FAN_TITLE = "the fans' verdict"
COMMENTS_MARKER = "Here are some of your comments:"

# Keys
ARTICLE_KEY_LENGTH = 16

# Classes
NEUTRAL_BAND = 0.2
SUBJECTIVE_FROM = 0.5
SENTIMENTS = (
    ("negative", 0, -1),
    ("neutral", 1, 0),
    ("positive", 3, 1),
)

# Stored table whose name differs from the table's own
TREND_TABLE_NAME = "df_fact_sentiment_trend"

# --- End of fixed values ----------------------------------------------------------------------------------------------
