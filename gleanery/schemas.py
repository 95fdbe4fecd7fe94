"""Table schemas and label domains."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_S, _I, _L, _B = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()

#: Record dump of the first platform as landed (ids and dates stay text).
GOOGLE_PLAY_RAW = _table(
    reviewId=_S, userName=_S, score=_I, at=_S, content=_S, replyContent=_S, thumbsUpCount=_I
)

#: Flattened feed of the second platform.
APP_STORE_RAW = _table(
    reviewId=_S, userName=_S, rating=_I, date=_S, title=_S, review=_S, isEdited=_B
)

#: One landed feed page: the JSON document is kept as text.
FEED_PAGE = _table(app_id=_S, country=_S, page=_I, body=_S)

UNIFIED = _table(platform=_S, reviewId=_S, userName=_S, rating=_I, date=_S, content=_S)
UNLABELED = _table(reviewId=_S, platform=_S, text=_S, primary=_S, secondary=_S)
LABELED = UNLABELED

#: Where a row stood in its source; rows of one source compare in reading order.
SOURCE_ORDER = _table(source=_S, block=_L, row=_L)

# Platform tags.
GOOGLE_PLAY = "google_play"
APP_STORE = "app_store"

# The two closed label domains and their fallbacks.
PRIMARY_LABELS = ("BUG", "UI/UX", "FEATURE_REQUEST", "PERFORMANCE", "POSITIVE", "INVALID")
SECONDARY_LABELS = ("ACCOUNT", "TRANSACTION", "CREDIT_CARD", "GENERAL")
PRIMARY_FALLBACK = "INVALID"
SECONDARY_FALLBACK = "GENERAL"

# Spellings accepted for each label, grouped by the label they mean.
PRIMARY_SPELLINGS = {
    "UI/UX": ("UX", "UI", "UIUX"),
    "FEATURE_REQUEST": ("REQUEST", "FEATURE"),
    "PERFORMANCE": ("SLOW", "LAG"),
    "BUG": ("CRASH", "ERROR", "BUG_REPORT"),
    "POSITIVE": ("PRAISE", "POSITIVE_REVIEW"),
    "INVALID": ("UNKNOWN", "N/A", "SPAM"),
}
SECONDARY_SPELLINGS = {
    "ACCOUNT": ("LOGIN", "AUTH", "ACCOUNT_INQUIRY", "HISTORY", "BALANCE"),
    "TRANSACTION": ("PAYMENT", "PAY", "TRANSFER", "WIRE", "REMITTANCE", "QR"),
    "CREDIT_CARD": ("CARD", "CREDITCARD", "CC", "STATEMENT", "BILL", "REWARD"),
    "GENERAL": ("APP", "HOMEPAGE", "SETTINGS", "NOTIFICATION"),
}

# Keys under which a response item may carry each label, best first.
PRIMARY_KEYS = ("primary", "primary_label", "primaryLabel", "primaryCategory", "primary_category")
SECONDARY_KEYS = (
    "secondary", "secondary_label", "secondaryLabel", "secondaryCategory", "secondary_category"
)
