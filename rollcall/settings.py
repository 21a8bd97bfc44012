"""Default rules. A caller passes its own dicts to change them."""

from __future__ import annotations

# Score weights.
WEIGHTS = {
    "has_website": 5,
    "cms_bitrix": 10,
    "cms_modern": 3,
    "has_marquiz": 8,
    "has_telegram": 15,
    "has_whatsapp": 10,
    "tg_trust_multiplier": 2,
    "multiple_phones": 5,
    "has_email": 5,
    "is_network": 5,
}

# Lowest score of each segment; anything below C is D.
LEVELS = {"segment_A": 50, "segment_B": 30, "segment_C": 15}

# Levels used where a configuration names none.
FALLBACK_LEVELS = {"segment_A": 60, "segment_B": 40, "segment_C": 20}

# Site builders that count as modern.
MODERN_CMS = ("wordpress", "tilda", "flexbe")

# Export presets.
PRESETS = {
    "hot_leads": {
        "description": "Есть TG/WA + высокий CRM-скор",
        "filters": "telegram IS NOT NULL AND crm_score >= 50",
        "format": "csv",
    },
    "high_score": {
        "description": "Высокий CRM-скор (сегмент A)",
        "filters": "segment = 'A'",
        "format": "csv",
    },
    "with_telegram": {
        "description": "Все компании с найденным Telegram",
        "filters": "telegram IS NOT NULL",
        "format": "csv",
    },
    "cold_email": {
        "description": "Нет мессенджеров, но есть Email",
        "filters": "telegram IS NULL AND whatsapp IS NULL AND emails IS NOT NULL",
        "format": "csv",
    },
    "manual_search": {
        "description": "Нет мессенджеров — нужен прозвон",
        "filters": "telegram IS NULL AND whatsapp IS NULL",
        "format": "markdown",
    },
    "full_dump": {
        "description": "Все обогащённые компании",
        "filters": "1=1",
        "format": "json",
    },
}

# Page marks of each site builder, first match wins.
CMS_MARKS = (
    ("wordpress", ("wp-content", "WordPress")),
    ("bitrix", ("bitrix", "1c-bitrix")),
    ("tilda", ("tilda.ws", "tilda.cc", "created on Tilda")),
    ("flexbe", ("flexbe",)),
    ("lpmotor", ("lpmotor",)),
    ("joomla", ("Joomla",)),
    ("opencart", ("OpenCart", "route=common/home")),
)

# Fixed value: page mark of the quiz widget.
QUIZ_MARK = "marquiz.ru"

# Words by which a profile is relevant.
RELEVANT_WORDS = ("ритуал", "похорон", "памятник", "мемориал", "funeral", "angel")

# Words of a link text, and of a link target, that lead to a contact page.
CONTACT_TEXT_WORDS = ("контакт", "связ", "телефон", "обратн", "написать")
CONTACT_HREF_WORDS = ("contact", "kontakt")

# Words of link targets worth a further visit.
EXTRA_PAGE_WORDS = (
    "about",
    "o-nas",
    "o_kompanii",
    "production",
    "proizvodstvo",
    "catalog",
    "katalog",
    "uslugi",
    "services",
)

# Keyword tags of company pages.
TAG_WORDS = {
    "equipment": (
        "лазерный станок",
        "ЧПУ",
        "CNC",
        "фрезерный станок",
        "гравировальный станок",
        "Сауно",
        "Миртелс",
        "Trotec",
        "Epilog",
        "лазерная гравировка",
        "станок с ЧПУ",
    ),
    "production": (
        "собственное производство",
        "цех",
        "производственная база",
        "изготовление на заказ",
        "работаем с гранитом",
        "производство памятников",
        "гранитная мастерская",
    ),
    "portrait": (
        "ретушь фото",
        "обработка портретов",
        "фото на памятник",
        "коррекция фото",
        "цветная печать на граните",
        "портрет на памятник",
    ),
    "site_constructor": (
        "tilda",
        "tildaweb",
        "wix.com",
        "ucoz",
        "narod.ru",
        "jimdo",
        "weebly",
        "wordpress.com",
    ),
}

# IPv4 networks a public site never lives in.
PRIVATE_NETWORKS = (
    "10.0.0.0/8",
    "172.16.0.0/12",
    "192.168.0.0/16",
    "169.254.0.0/16",
    "0.0.0.0/8",
    "100.64.0.0/10",
    "192.0.0.0/24",
    "192.0.2.0/24",
    "198.51.100.0/24",
    "203.0.113.0/24",
)

# Hosts that are always internal.
LOCAL_HOSTS = ("localhost", "127.0.0.1", "::1")

# Collecting sources in their usual order.
STANDARD_SOURCES = ("jsprav", "firecrawl", "dgis", "yell", "firmsru")

# Directory category and the subdomains that do not follow the slug rule.
DIRECTORY_CATEGORY = "izgotovlenie-i-ustanovka-pamyatnikov-i-nadgrobij"
SUBDOMAINS = {
    "астрахань": "astrahan",
    "москва": "moskva1",
    "санкт-петербург": "sankt-peterburg1",
}

# Fixed value: name similarity, in percent, from which two names match.
NAME_SIMILARITY = 88

# Fixed value: keys from this many companies on mark a branch network.
NETWORK_SIZE = 2

# Phrases a city or region is searched with.
SEARCH_PHRASES = (
    "гранитная мастерская памятники",
    "производство памятников гранит",
    "мастерская по изготовлению памятников",
    "гранит памятники надгробия",
    "изготовление памятников из гранита",
)
