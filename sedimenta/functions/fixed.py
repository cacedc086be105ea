"""Results depend on these word lists, hosts, statuses and bounds as they are."""

# Sites whose pages are posts, by domain and its subdomains.
SOCIAL_DOMAINS = {
    "facebook.com": "public_facebook_post",
    "x.com": "public_x_post",
    "twitter.com": "public_x_post",
    "instagram.com": "public_instagram_post",
    "t.me": "public_telegram_post",
    "telegram.me": "public_telegram_post",
    "youtube.com": "youtube_page",
    "youtu.be": "youtube_page",
}
IMAGE_SUFFIXES = [".jpg", ".jpeg", ".png", ".gif", ".webp", ".avif", ".tif", ".tiff", ".svg"]
VIDEO_SUFFIXES = [".mp4", ".mov", ".avi", ".mkv", ".webm", ".m4v"]
AUDIO_SUFFIXES = [".mp3", ".wav", ".ogg", ".m4a", ".aac", ".flac"]
GOVERNMENT_TOKENS = ["gov", "mil", "وزارة", "government", "defense", "ministry"]
NGO_TOKENS = ["hrw", "amnesty", "ngo", "observatory", "المرصد", "حقوق"]
BLOG_TOKENS = ["blog", "wordpress", "blogspot"]
NEWS_TOKENS = ["news", "media", "press", "أخبار", "اخبار", "agency"]

ARCHIVE_HOSTS = [
    "archive.fo",
    "archive.is",
    "archive.li",
    "archive.md",
    "archive.ph",
    "archive.today",
    "archive.vn",
    "arquivo.pt",
    "ghostarchive.org",
    "perma.cc",
    "timetravel.mementoweb.org",
    "wayback.archive-it.org",
    "web.archive.org",
]
DEFAULT_ARCHIVE_HOST = "web.archive.org"

# Query keys that say where a visitor came from.
TRACKING_KEYS = ["fbclid", "gclid", "mc_cid", "mc_eid"]
TRACKING_PREFIX = "utm_"
X_TRACKING_KEYS = ["s", "t", "ref_src"]

# Texts of pages that show no content of their own.
SHELL_MARKERS = [
    "log in to facebook",
    "see more on facebook",
    "create new account",
    "something went wrong",
    "this browser is no longer supported",
    "don’t miss what’s happening",
    "don't miss what's happening",
    "people on x are the first to know",
    "javascript is not available",
    "enable javascript and cookies to continue",
    "just a moment",
    "checking your browser",
    "verify you are human",
    "attention required",
    "access denied",
    "captcha",
    "يرجى التحقق من أنك إنسان",
    "تم رفض الوصول",
]
LOGIN_WALL_MARKERS = [
    "log in to continue",
    "login to continue",
    "sign in to continue",
    "log into facebook",
    "log in to facebook",
    "تسجيل الدخول للمتابعة",
    "سجّل الدخول للمتابعة",
    "قم بتسجيل الدخول للمتابعة",
]
SHELL_PATTERNS = [
    ("facebook_login_shell", r"(?iu)(?:log in to facebook|login to facebook|войдите на facebook|познакомьтесь с тем, что вам нравится|электронный адрес или номер мобильного телефона|facebook\s+email(?: address)?\s+password)"),
    ("facebook_unavailable", r"(?iu)(?:this (?:facebook )?post is (?:no longer )?available|эта публикация facebook больше не доступна|публикация недоступна|владелец удалил контент|owner (?:has )?removed the content|content (?:is|might be) unavailable|page (?:is|currently) unavailable|страница сейчас недоступна)"),
    ("video_unavailable", r"(?iu)(?:video (?:is )?unavailable|видео недоступно|данного видео не существует|problems? (?:playing|reproducing) this video|проблемы с воспроизведением)"),
    ("restricted_or_login_required", r"(?iu)(?:please log in to (?:see|view)|пожалуйста, выполните вход|age-restricted adult content|you do not have (?:access|permission)|у вас нет доступа)"),
    ("generic_access_shell", r"(?iu)(?:access denied|enable javascript to run this app|verify you are human|captcha|just a moment\.\.\.|account (?:has been )?suspended|this domain is for sale|page cannot be displayed|contact your service provider)"),
]

# Quality scoring: the least length by kind, what a fault costs, and where markers and repetition count.
LEAST_LENGTH_PUBLIC, LEAST_LENGTH = 16, 40
COST_SHORT, COST_SHELL, COST_REPETITIVE = 55, 70, 45
SHELL_BELOW_LENGTH = 1500
REPETITION_FROM_WORDS, REPETITION_RATIO = 30, 0.18
PARTIAL_SCORE_CAP = 80

# Declared languages by what their label holds, in this order; then the shares of letters by script.
DECLARED_LANGUAGES = [
    ("arab", "ar"),
    ("العرب", "ar"),
    ("english", "en"),
    ("turkish", "tr"),
    ("türk", "tr"),
    ("kurdish", "ku"),
    ("kurdî", "ku"),
    ("persian", "fa"),
    ("farsi", "fa"),
    ("hebrew", "he"),
    ("russian", "ru"),
    ("french", "fr"),
    ("spanish", "es"),
    ("german", "de"),
]
SCRIPT_SHARE, LATIN_SHARE = 0.35, 0.7

# Content statuses, run and collection statuses.
SOURCE_STATUSES = [
    "REFERENCE_ONLY",
    "URL_PRESERVED",
    "METADATA_ONLY",
    "PARTIAL_TEXT",
    "FULL_TEXT_DIRECT",
    "FULL_TEXT_ARCHIVED",
    "FULL_TEXT_LOCAL_SNAPSHOT",
    "BLOCKED",
    "DEAD",
    "MALFORMED",
    "RESTRICTED",
    "NEEDS_MANUAL_REVIEW",
]
RESOLVED_STATUSES = ["successful", "successful_partial", "cached", "embedded_text_preserved"]
POLICY_COMPLETE_STATUSES = ["media_metadata_preserved"]

# HTTP statuses by what they say.
BLOCKED_HTTP = [401, 403, 429, 451]
DEAD_HTTP = [404, 410]
BLOCKED_WORDS = ["access denied", "blocked", "login_required", "captcha", "http_403", "http_429"]
RETRY_WORDS = ["timeout", "tempor", "connection", "circuit"]

# The region that records are expected in, inclusive.
REGION = {"lat": (31.0, 38.0), "lon": (34.0, 43.0)}

# Priorities of text found under JSON keys, and the least length of such a text.
TEXT_KEYS = {"articlebody": 120, "article_body": 120, "body": 80, "content": 75, "text": 70, "description": 45, "summary": 45, "caption": 35, "message": 35}
TEXT_KEY_LEAST = 24
#: The run of blocks with the most text: behind what a page marks as its content, before all that is left.
MAIN_RUN_PRIORITY = 90
JSON_LD_BONUS, SEMANTIC_PRIORITY, META_PRIORITY, BODY_PRIORITY = 30, 100, 20, 5
CANDIDATE_LENGTH_CAP = 250_000
JSON_DEPTH, JSON_NODES = 18, 20_000

# Origins of a field's value; a value of higher priority wins.
PRIORITY_OF_ORIGIN = {"api": 3, "live": 2, "archive": 1, "historical": 0}

# Letters whose folded form isn't their lower case.
FOLDED_LETTERS = {"ß": "ss", "ſ": "s", "ς": "σ", "ŉ": "ʼn", "և": "եւ", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st", "µ": "μ"}
