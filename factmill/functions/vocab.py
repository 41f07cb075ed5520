"""Closed vocabularies and default weights; all are arguments of the functions that use them."""

# Fixed values of the data contract.
GOVERNMENT_SOURCES = ("government_filing", "official_remarks", "government_policy", "government_procurement", "regulatory_action")
ISSUER_SOURCES = ("issuer_release",)
MEDIA_SOURCES = ("financial_media",)
EVENT_TYPES = ("disclosure_buy", "public_mention", "policy_capital", "procurement", "regulatory_action", "market_reaction")
RELATIONSHIPS = ("issuer", "direct_beneficiary", "industry_context", "unverified")
BUCKET_WEIGHTS = {"named_mentioned": 4, "policy_capital": 4, "disclosed_holding": 2, "drone_policy_watchlist": 2}
EVENT_WEIGHTS = {"public_mention": 4, "policy_capital": 4, "procurement": 4, "disclosure_buy": 3, "regulatory_action": 3, "market_reaction": 1}
CONFIDENCE_WEIGHTS = {"high": 3, "medium": 2, "low": 1}
PROCUREMENT_TERMS = ("contract", "procurement", "award")
POLICY_TERMS = ("policy", "funding", "capital", "stake")
NEGATIVE_TERMS = ("avoid", "ban", "sanction", "investigation", "risk", "delay", "block", "bearish", "sell")
POSITIVE_TERMS = ("buy", "bullish", "great", "partner", "award", "funding", "capital", "support", "contract", "upside")
ROW_KEYS = ("item_id", "published_at", "source_type", "source_url", "author", "text")
MAX_SAFE_INTEGER = 2**53 - 1
MAX_ROWS_PER_FEED = 10_000
MAX_PAYLOAD_BYTES = 1 << 20
EMPTY_DIGEST = "4f53cda18c2baa0c0354bb5f9a3ecbe5ed12ab4d8e11ba873c2f11161202b945"
FEED_KINDS = ("rss2", "atom", "unknown")
FEED_STATES = ("accepted", "failed", "quarantined")
ERROR_CODE = "^[a-z][a-z0-9_]{0,63}\\z"
DIGEST = "^[0-9a-f]{64}\\z"
ATOM = "{http://www.w3.org/2005/Atom}"
DUBLIN_CORE = "{http://purl.org/dc/elements/1.1/}"
CONTENT = "{http://purl.org/rss/1.0/modules/content/}"
