"""Domain constants and the constraint table (1.3, B12)."""

from __future__ import annotations

# fixed values: the ten-category taxonomy, in the reference's order
TAXONOMY = ("business_critical", "financial_news", "marketing", "notifications", "spam_low_value",
            "personal_communication", "industry_news", "internal", "regulatory", "uncategorized")

# fixed values: enum constraints of the reference schema that apply to the fixture tables
ENUMS = {
    ("desired_state", "attention_tier"): ("A", "B"),
    ("desired_state", "importance"): ("high", "normal", "low"),
    ("desired_state", "sync_status"): ("pending", "synced", "failed", "partial", "user_modified"),
    ("decision", "primary_category"): TAXONOMY,
    ("list_entry", "list_type"): ("vip_finance", "vip_personal", "personal", "business_critical", "internal",
                                  "blocked", "newsletter"),
    ("list_entry", "identifier_type"): ("from_address", "from_address_contains", "from_domain",
                                        "message_id_domain", "list_domain", "unsub_domain"),
}
RANGES = {
    ("decision", "confidence"): (0, 100),
    ("sender", "confidence_score"): (0, 100),
    ("list_entry", "priority"): (1, 100),
}
NOT_NULL = {
    "mail": ("message_id", "received_datetime"),
    "decision": ("message_id",),
    "desired_state": ("message_id", "attention_tier"),
    "list_entry": ("list_type", "identifier_type", "identifier_value", "target_category"),
}
UNIQUE = {
    "mail": ("message_id",),
    "desired_state": ("message_id",),
    "content": ("message_id",),
    "header": ("message_id",),
    "list_entry": ("list_type", "identifier_type", "identifier_value"),
    "rule": ("version", "feature", "key_value"),
    "sender": ("sender_key",),
}
# child table -> key column that must exist in mail
FOREIGN_KEYS = {
    "decision": "message_id",
    "content": "message_id",
    "header": "message_id",
    "desired_state": "message_id",
    "feedback": "message_id",
    "body": "message_id",
}
