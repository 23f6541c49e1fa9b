"""Rule sets as plain data. Fixed values, which results depend on."""

from __future__ import annotations

from dataclasses import dataclass, field

# Category -> words that tag it (whole words in headline or body), in output order.
CATEGORY_WORDS = {
    "COPPER": ["copper", "銅"],
    "ALUMINIUM": ["aluminum", "aluminium", "アルミ"],
    "ZINC": ["zinc", "亜鉛"],
    "LEAD": ["lead", "鉛"],
    "NICKEL": ["nickel", "ニッケル"],
    "TIN": ["tin", "スズ", "錫"],
    "EQUITY": ["equity", "equities", "stock", "stocks", "share", "shares", "株式", "株価"],
    "FOREX": ["forex", "fx", "currency", "currencies", "exchange rate", "為替", "外国為替", "通貨"],
    "COMMODITIES": ["commodity", "commodities", "商品", "コモディティ"],
}

# Category -> phrases that tag it anywhere in the headline; these come last.
HEADLINE_PHRASES = {"NY_MARKET": ["ny市場サマリー", "ｎｙ市場サマリー"]}

# Category -> search terms (substrings).
SEARCH_TERMS = {
    "COPPER": ["copper", "銅"],
    "ALUMINIUM": ["aluminium", "aluminum", "アルミ"],
    "ZINC": ["zinc", "亜鉛"],
    "LEAD": ["lead metal", "鉛"],
    "NICKEL": ["nickel", "ニッケル"],
    "TIN": ["tin", "スズ", "錫"],
    "EQUITY": ["equity", "stock"],
    "FOREX": ["forex", "foreign exchange"],
    "COMMODITIES": ["commodity", "commodities"],
    "NY_MARKET": ["ＮＹ市場サマリー", "NY市場", "ニューヨーク市場"],
}

# Urgency level -> substrings; the smallest level that matches counts, else 3.
URGENCY_WORDS = {
    1: ["breaking", "urgent", "alert", "flash", "emergency", "速報", "緊急"],
    2: ["important", "significant", "major", "重要", "重大"],
}

# Level -> score and substrings of the priority rules.
PRIORITY_TERMS = {
    "high_priority": {
        "score": 10,
        "terms": ["strike", "shutdown", "supply cut", "force majeure", "production halt"],
    },
    "medium_priority": {
        "score": 5,
        "terms": ["price", "demand", "supply", "inventory", "lme", "china", "forecast"],
    },
    "low_priority": {"score": 2, "terms": ["trade", "market", "report", "analyst", "outlook"]},
}

EXCLUDED_SOURCES = ["spam", "advertisement"]
SECRET_KEYS = ["api_key", "password", "token", "secret"]


@dataclass(frozen=True)
class Rules:
    """Everything an ingest run is told; the defaults are the news vocabulary."""

    category_words: dict = field(default_factory=lambda: CATEGORY_WORDS)
    headline_phrases: dict = field(default_factory=lambda: HEADLINE_PHRASES)
    search_terms: dict = field(default_factory=lambda: SEARCH_TERMS)
    urgency_words: dict = field(default_factory=lambda: URGENCY_WORDS)
    priority_terms: dict = field(default_factory=lambda: PRIORITY_TERMS)
    excluded_sources: list = field(default_factory=lambda: EXCLUDED_SOURCES)
    category_minimum: dict = field(default_factory=dict)
    minimum_score: int = 0
    max_headline_length: int = 500
    similarity: float | None = 0.85  # None: near-duplicates are stored
    window_hours: int = 24

    @property
    def category_order(self) -> list[str]:
        return [*self.category_words, *self.headline_phrases]
