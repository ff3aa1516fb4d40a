"""User-agent text to bot, browser, system and device names."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

AGENT_FIELDS = [
    "_is_bot",
    "_bot_name",
    "_bot_class",
    "_browser",
    "_browser_version",
    "_os",
    "_device_type",
]

# Public crawler and client names by class, matched at the start of a word without
# regard to case.
BOTS = {
    "search": [
        "AdsBot-Google", "Googlebot-Image", "Googlebot-News", "Googlebot-Video", "Googlebot",
        "Storebot-Google", "Mediapartners-Google", "Google-InspectionTool", "bingbot",
        "BingPreview", "msnbot", "Slurp", "DuckDuckBot", "Baiduspider", "YandexBot",
        "YandexImages", "Sogou", "Exabot", "Qwantify", "SeznamBot", "PetalBot", "Applebot",
        "coccocbot", "Yeti", "MojeekBot",
    ],
    "social": [
        "facebookexternalhit", "facebookcatalog", "Twitterbot", "LinkedInBot", "Pinterestbot",
        "Slackbot", "TelegramBot", "WhatsApp", "Discordbot", "redditbot", "SkypeUriPreview",
        "vkShare", "Viber",
    ],
    "ai": [
        "GPTBot", "ChatGPT-User", "OAI-SearchBot", "ClaudeBot", "Claude-Web", "anthropic-ai",
        "CCBot", "PerplexityBot", "Google-Extended", "Bytespider", "cohere-ai", "Diffbot",
        "meta-externalagent", "Amazonbot", "YouBot",
    ],
    "seo-tool": [
        "AhrefsBot", "SemrushBot", "MJ12bot", "DotBot", "rogerbot", "BLEXBot", "DataForSeoBot",
        "serpstatbot", "SEOkicks", "Screaming Frog", "Sitebulb", "Barkrowler",
    ],
    "monitor": [
        "UptimeRobot", "Pingdom", "StatusCake", "Site24x7", "NewRelicPinger", "Datadog",
        "Better Uptime", "HetrixTools", "kube-probe", "ELB-HealthChecker", "GoogleHC",
        "Prometheus", "Zabbix", "Nagios",
    ],
    "scraper": [
        "curl", "Wget", "python-requests", "python-urllib", "aiohttp", "Scrapy", "Go-http-client",
        "okhttp", "Apache-HttpClient", "libwww-perl", "HTTrack", "axios", "node-fetch",
        "GuzzleHttp", "HeadlessChrome", "PhantomJS", "PostmanRuntime", "Java",
    ],
}
# Names that also occur inside other words count only in front of a version.
VERSIONED = ["Java", "Yeti", "Viber", "curl", "axios", "Prometheus", "Datadog"]

# What an unlisted bot calls itself, and the class it gets.
UNLISTED_WORDS = ["bot", "crawl", "spider", "scrape", "fetcher", "monitor"]
UNLISTED_CLASS = "scraper"
# Devices whose names hold one of the words above.
NOT_BOTS = ["cubot"]

# Browser name and the tokens its version follows, most specific first.
BROWSERS = [
    ("Edge", ["Edg/", "Edge/", "EdgA/", "EdgiOS/"]),
    ("Opera", ["OPR/", "OPiOS/", "Opera/"]),
    ("Samsung Internet", ["SamsungBrowser/"]),
    ("Yandex", ["YaBrowser/"]),
    ("Vivaldi", ["Vivaldi/"]),
    ("UC Browser", ["UCBrowser/"]),
    ("Firefox", ["Firefox/", "FxiOS/"]),
    ("Chrome", ["Chrome/", "CriOS/", "Chromium/"]),
    ("Internet Explorer", ["MSIE ", "Trident/"]),
    ("Safari", ["Safari/"]),
]
# Where the version stands when it does not follow the browser's own token.
VERSION_TOKENS = {"Safari": ["Version/"], "Internet Explorer": ["MSIE ", "rv:"]}

# System name and the texts that show it, most specific first.
SYSTEMS = [
    ("Windows Phone", ["Windows Phone"]),
    ("Xbox", ["Xbox"]),
    ("Windows", ["Windows"]),
    ("iOS", ["iPhone", "iPad", "iPod"]),
    ("tvOS", ["AppleTV", "Apple TV", "tvOS"]),
    ("macOS", ["Macintosh", "Mac OS X"]),
    ("Tizen", ["Tizen"]),
    ("webOS", ["Web0S", "webOS"]),
    ("PlayStation", ["PlayStation"]),
    ("Nintendo", ["Nintendo"]),
    ("KaiOS", ["KAIOS"]),
    ("Android", ["Android"]),
    ("Chrome OS", ["CrOS"]),
    ("FreeBSD", ["FreeBSD"]),
    ("Linux", ["Linux", "X11"]),
]

# Device class and the texts that show it, most specific first. An Android device
# that does not call itself mobile is a tablet.
DEVICES = [
    ("console", ["PlayStation", "Xbox", "Nintendo"]),
    ("smarttv", ["SMART-TV", "SmartTV", "Smart TV", "AppleTV", "Apple TV", "GoogleTV", "HbbTV",
                 "Web0S", "BRAVIA", "Roku"]),
    ("tablet", ["iPad", "Tablet", "Kindle", "Silk/"]),
    ("mobile", ["iPhone", "iPod", "Mobile", "Windows Phone", "BlackBerry", "KAIOS", "Opera Mini"]),
    ("tablet", ["Android"]),
    ("desktop", ["Windows", "Macintosh", "X11", "Linux", "CrOS", "FreeBSD"]),
]


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _has_any(text: str, tokens: list[str]) -> str:
    return " OR ".join(f"contains({text}, {_quoted(token)})" for token in tokens)


def _first(text: str, table: list[tuple[str, list[str]]], otherwise: str) -> str:
    """Name of the first table entry that has a token in the text.

    The table is a constant that a short loop goes over: a ladder of conditions grows beyond what the
    JVM compiles.
    """
    entries = ", ".join(
        f"named_struct('name', {_quoted(name)}, 'token', {_quoted(token)})"
        for name, tokens in table
        for token in tokens
    )
    found = f"get(filter(array({entries}), x -> contains({text}, x.token)), 0).name"
    return f"coalesce({found}, {_quoted(otherwise)})"


def _lookup(pairs: dict[str, str], key: str) -> str:
    entries = ", ".join(f"{_quoted(k)}, {_quoted(v)}" for k, v in pairs.items())
    return f"try_element_at(map({entries}), {key})"


def _token(name: str) -> str:
    return name.lower() + ("/" if name in VERSIONED else "")


def _prefix_pattern(words: list[str]) -> str:
    """A pattern for any of the words that tests each shared beginning once."""
    ends = "" in words
    heads = sorted({word[0] for word in words if word})
    branches = [
        re.escape(head) + _prefix_pattern([w[1:] for w in words if w.startswith(head)])
        for head in heads
    ]
    if not branches:
        return ""
    if len(branches) == 1 and not ends:
        return branches[0]
    return f"(?:{'|'.join(branches)})" + ("?" if ends else "")


def listed_bot(lower: str) -> str:
    """The first listed name in a lower-case text, or ``''``. One pass over the text."""
    tokens = [_token(name) for names in BOTS.values() for name in names]
    pattern = _quoted(rf"\b({_prefix_pattern(tokens)})")
    return f"coalesce(regexp_extract({lower}, {pattern}, 1), '')"


def bot_name(agent: str, lower: str, listed: str) -> str:
    """Name of the bot, or ``''``, from the text, it in lower case, and the listed name found in it."""
    word = "[a-z0-9_.-]*"
    pattern = _quoted(f"(?i)({word}(?:{'|'.join(UNLISTED_WORDS)}){word})")
    display = {_token(name): name for names in BOTS.values() for name in names}
    return (
        f"CASE WHEN {listed} <> '' THEN {_lookup(display, listed)} "
        f"WHEN ({_has_any(lower, UNLISTED_WORDS)}) AND NOT ({_has_any(lower, NOT_BOTS)}) "
        f"THEN regexp_extract({agent}, {pattern}, 1) ELSE '' END"
    )


def bot_class(name: str, listed: str) -> str:
    """Class of a bot by its name; ``''`` for no bot."""
    classes = {_token(n): kind for kind, names in BOTS.items() for n in names}
    return (
        f"CASE WHEN {listed} <> '' THEN {_lookup(classes, listed)} "
        f"WHEN {name} <> '' THEN {_quoted(UNLISTED_CLASS)} ELSE '' END"
    )


def browser_version(agent: str, product: str) -> str:
    """Major version of the browser called ``product``."""
    arms = []
    for name, tokens in BROWSERS:
        choices = "|".join(VERSION_TOKENS.get(name, tokens))
        pattern = _quoted(f"(?:{choices})([0-9]+)")
        arms.append(f"WHEN {_quoted(name)} THEN regexp_extract({agent}, {pattern}, 1)")
    return f"CASE {product} {' '.join(arms)} ELSE '' END"


def with_agent(rows: DataFrame, agent: str, fields: list[str]) -> DataFrame:
    """Add the requested user-agent fields, worked out from the column ``agent``.

    The values that several fields share come first, in a step of their own, so that each is
    worked out once per row; no row leaves its partition. A missing or ``-`` text names nothing.
    """
    wanted = [name for name in AGENT_FIELDS if name in fields]
    steps: list[dict[str, str]] = [{}, {}, {}]
    if {"_is_bot", "_bot_name", "_bot_class"} & set(wanted):
        steps[0]["_lower"] = f"lower({agent})"
        steps[1]["_listed"] = listed_bot("_lower")
        steps[2]["_bot"] = bot_name(agent, "_lower", "_listed")
    if {"_browser", "_browser_version"} & set(wanted):
        steps[0]["_product"] = _first(agent, BROWSERS, "")
    values = {
        "_is_bot": "CASE WHEN _bot <> '' THEN '1' ELSE '0' END",
        "_bot_name": "_bot",
        "_bot_class": bot_class("_bot", "_listed"),
        "_browser": "_product",
        "_browser_version": browser_version(agent, "_product"),
        "_os": _first(agent, SYSTEMS, ""),
        "_device_type": _first(agent, DEVICES, "unknown"),
    }
    for step in [*steps, {column: values[column] for column in wanted}]:
        rows = rows.selectExpr("*", *[f"{sql} AS {column}" for column, sql in step.items()])
    return rows.drop(*[column for step in steps for column in step])
