"""Fixed values.

Names, weights, patterns and texts that results depend on.  They are part of the
data contract, so they are stated here once, as plain text.
"""

# --- e-mail event file -------------------------------------------------------
REQUIRED_COLUMNS = (
    "event_id",
    "user_email",
    "event_type",
    "event_timestamp",
    "message_details",
)
REQUIRED_JSON_KEYS = ("campaign_code",)
MISSING_COLUMNS_MESSAGE = "colunas obrigatórias"

# --- quality gate ------------------------------------------------------------
REASON_EMPTY = "message_details is null or empty"
REASON_MALFORMED = "JSONDecodeError: malformed JSON"
REASON_MALFORMED_PREFIX = "JSONDecodeError: "
REASON_MISSING_KEYS_PREFIX = "Missing required JSON fields: "
REASON_NOT_OBJECT = "not a JSON object"
REASON_BAD_RECORD = "malformed CSV record"
QUARANTINE_ALERT_PCT = 10.0

# --- keys --------------------------------------------------------------------
COUNTRY_CODE = "55"
LOCAL_NUMBER_LENGTHS = (10, 11)

# --- time --------------------------------------------------------------------
LOCAL_ZONE = "America/Sao_Paulo"
WINDOW_DAYS = 7
RETENTION_DAYS = 90

# --- campaign tags -----------------------------------------------------------
TAG_PATTERN = r"\[WA\] - ([^-]+) -"
LEGACY_TAG_PATTERN = r"\[CAMP:([^\]]+)\]"

# --- interaction weights -----------------------------------------------------
EMAIL_WEIGHTS = {"click": 2, "open": 3, "sent": 4, "delivered": 4}
WHATSAPP_WEIGHTS = {"read": 1, "delivered": 4, "sent": 4}
UNKNOWN_WEIGHT = 99
FALLBACK_WEIGHT = 4
WEIGHT_LABELS = {
    1: "WhatsApp Read",
    2: "Email Click",
    3: "Email Open",
    4: "Sent/Delivered (fallback)",
}
UNKNOWN_LABEL = "Unknown"

EMAIL_CHANNEL = "email"
WHATSAPP_CHANNEL = "whatsapp"
