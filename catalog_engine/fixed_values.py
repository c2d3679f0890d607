"""Fixed values.

Word lists, site names, section names and labels that decide which rows and
words survive. They are data, not logic: results only agree when they are the
same. Every operator takes them as a parameter and these are the defaults.
"""

# --- entries -------------------------------------------------------------

ENTRY_CATEGORY = "Meme"

# Title fragments that exclude an entry (case sensitive).
TITLE_DENY_LIST = [
    "fuck", "shit", "dick", "Fuck", "Shit", "Dick", "FUCK", "penis", "Penis", "PENIS", "Gay", "gay",
    "GAY", "Naked", "poop", "Poop", "Nigga", "Nigger", "nigga", "Suck", "Cock", "Porn", "porn", "Ass",
    "Raped", "raped", "Rape", "Pussy", "Cunt", "Bitch",
]

# Fixed value: how many of the lowest short ids are symbol-only links.
LOWEST_IDS_DROPPED = 16

# Entries whose page is gone, then entries without a description.
EXCLUDED_URLS = [
    "https://knowyourmeme.com/memes/temmie",
    "https://knowyourmeme.com/memes/its-all-mtv",
    "https://knowyourmeme.com/memes/x-sells-everything-to-y",
    "https://knowyourmeme.com/memes/ap-gibralter",
    "https://knowyourmeme.com/memes/chili-can-be-served-with-cheese",
    "https://knowyourmeme.com/memes/hyakugojyuuichi--2",
    "https://knowyourmeme.com/memes/tequila-heineken-pas-ltemps-dniaiser",
    "https://knowyourmeme.com/memes/schismatic-pony",
    "https://knowyourmeme.com/memes/gaul-laughing-stock",
    "https://knowyourmeme.com/memes/texting-etiquette",
    "https://knowyourmeme.com/memes/got-my-nugs",
    "https://knowyourmeme.com/memes/dj-jesus-the-god-of-electronic-music",
    "https://knowyourmeme.com/memes/theflyingcamel",
    "https://knowyourmeme.com/memes/beauty-pageant-reaction",
    "https://knowyourmeme.com/memes/boom-boom-boom-mohammed",
    "https://knowyourmeme.com/memes/van-persie-fall",
    "https://knowyourmeme.com/memes/bad-romance-fail",
    "https://knowyourmeme.com/memes/my-foot",
    "https://knowyourmeme.com/memes/azerbaijan-dance",
]

# --- links ---------------------------------------------------------------

# What makes a reference value a link.
LINK_STARTS = ["http", "www"]
LINK_PARTS = [".org", ".com", ".net", "encyclopediadramatica.wiki"]

# Parts that make a link unusable (other sites and languages).
LINK_REJECTS = [
    "facebook", "translate", "uncyclopedia", "youtu.be", "/nl.", "/es.", "/fr.", "/zh.", "/zh-", "/sv.",
    "/da.", "/pt.", "/au.", "/hu.", "/it.", "/no.", "/ja.", "/id.", "/fi.", "/de.", "/cs.", ".ch/",
    ".nl/", ".es/", ".fr/", ".zh/", ".sv/", ".pt/", ".no/", ".ja/", ".id/", ".fi/", ".de/", ".cs/",
    ".au/", ".it/", ".hu/", ".da/", " ",
]
LINK_REJECT_START = "pt."
LINK_MIN_LENGTH = 8
LINK_SKIPPED_KEY = "Facebook"

# Reference column -> part of the link that puts it there, in order of precedence.
LINK_SITES = [
    ("ref_wikipedia", "wikipedia"),
    ("ref_urban_dict", "urbandictionary"),
    ("ref_encyc_dramatica", "encyclopediadramatica"),
    ("ref_meme_generator", "memegenerator"),
    ("ref_reddit", "reddit"),
    ("ref_twitter", "twitter"),
]
LINK_OTHER = "ref_other"

# Image links of the catalogue's own host are not alternatives.
OWN_IMAGE_HOST = "kym-cdn"
MAX_ALTERNATIVE_URLS = 6
MAX_SIMILAR_URLS = 10

# --- keywords and tags ---------------------------------------------------

# Characters and the literal fragment deleted from keywords.
KEYWORD_DELETED_CHARS = "\\\"'#"
KEYWORD_DELETED_FRAGMENT = ",geo:,time:all},{keyword:"

# Keyword starts that mark left-over escapes.
KEYWORD_DROPPED_STARTS = [
    "uba3", "ub4", "uac", "u9", "u8", "u7", "u6", "u5", "u4", "u3", "u2", "u1", "u0", "/m/", "(u",
    "#u", "^", "!1",
]

# Tags too frequent to search by.
DROPPED_TAGS = [
    "4chan", "youtube", "image macro", "twitter", "meme", "photoshop", "tumblr", "video", "reddit",
    "facebook", "youtube poop", "hashtag", "image", "gif", "racism", "memes", "sex", "you", "photo", "of",
    "i", "image macros", "google", "is", "youtube", "comment", "comments",
]

# Linked entities that say nothing about an entry.
DROPPED_ENTITIES = [
    "meme", "YouTube", "image macro", "catchphrase", "macros", "Twitter", "expression", "4chan", "Tumblr",
    "hashtag", "remix", "Internet", "Reddit", "social media", "slang", "English", "Facebook", "viral video",
    "video sharing", "fandom", "copypasta", "music video", "phrasal template", "Instagram", "YTMND",
    "YouTube Poop", "GIF", "Meme", "imageboard", "Internet slang", "internet slang", "YouTuber", "Google",
    "subreddit", "Photoshop", "MS Paint", "Go", "This Is", "/pol/", "animated GIF", "flash animation",
    "internet meme", "macro", "internet memes", "Youtube Poop", "2channel", "fuck", "stock photo", "3D",
    "Windows", "verb", "2chan", "signify", "GIF animation", "Internet slang", "internet slang",
]

# Words removed from the merged search keywords.
STOP_WORDS = [
    "meme", "image", "internet", "your", "know", "the", "of", "gif", "video", "and", "photo", "clip",
    "font",
    "caption", "catchphrase", "text", "blog", "macro", "you", "is", "my", "in", "media", "memes", "to",
    "youtube", "on", "for", "me", "it", "with", "jpeg", "this", "online", "wiki", "one", "that", "not",
    "at",
    "can", "are", "what", "download", "up", "youtuber", "do", "its", "all", "dont", "us", "we", "get",
    "have",
    "has", "twitter", "be", "ii", "from", "am", "will", "de", "out", "how", "facebook", "pictures", "just",
    "an", "iii", "was", "if", "who", "when", "over", "picture", "by", "down", "cant",
]

# Characters deleted from every keyword (ASCII punctuation and digits).
PUNCTUATION_AND_DIGITS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~0123456789"

# White space other than the blank that is trimmed off a word.
OTHER_WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# --- sections of an entry ------------------------------------------------

# Section names gathered into one column each.
SECTIONS = {
    "about": ["about", "about:", "about.", "about & origin", "about and origin", "origin/about"],
    "origins": [
        "origin", "origins", "origin:", "orgin", "origin and character", "origin and spread", "the origin",
        "origins:", "search for the origin", "origins/early development", "origin.", "origins and spread",
    ],
    "spread": [
        "spread", "popularity", "in popular culture", "spread and popularity", "popular culture",
        "popularity and spread", "viral spread", "spread & popularity",
        "mainstream coverage and declining popularity", "impact", "fandom", "online presence",
    ],
    "search_interest": [
        "search interest", "search", "search interests", "trend", "search trends",
        "google insights for search", "search trend", "search analytics", "search interest:",
        "search insight", "google search interest", "google insight", "google insights", "insight",
        "notable developments",
    ],
    "similar_images": [
        "examples", "various examples", "notable examples", "notable images", "variations",
        "notable developments", "derivatives", "derivative works",
        "direct derivatives",
    ],
}
PLACEHOLDER_TEXTS = ["in progress", "not available"]

# --- image recognition ---------------------------------------------------

BLOCKED_LIKELIHOODS = ["VERY_LIKELY"]
BLOCKING_CATEGORIES = ["medical", "violence", "adult"]
SAFE_SEARCH_COLUMNS = ["adult", "medical", "racy", "spoof", "violence"]
KEPT_LANGUAGE = "en"

# --- people --------------------------------------------------------------

# How many of the lowest author names are not names, and two literal non-names.
LOWEST_NAMES_DROPPED = 23
DROPPED_NAMES = ["", "200"]

# --- graph ---------------------------------------------------------------

UNKNOWN = "unknown"
LIST_EDGES = 5
