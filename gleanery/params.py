"""Operator parameters with their bounds, checked when built."""

from __future__ import annotations

from dataclasses import dataclass, field

from gleanery.functions.text import CJK_IDEOGRAPHS, Ranges
from gleanery.schemas import PRIMARY_FALLBACK, SECONDARY_FALLBACK


def _at_least(name: str, value: float, bound: float) -> None:
    if value < bound:
        raise ValueError(f"{name} must be >= {bound}, got {value}")


@dataclass(frozen=True)
class FeedParams:
    """How much of each feed to take; ``None`` means all of it."""

    review_count: int | None = None
    max_pages: int | None = None

    def __post_init__(self) -> None:
        if self.review_count is not None:
            _at_least("review_count", self.review_count, 1)
        if self.max_pages is not None:
            _at_least("max_pages", self.max_pages, 1)


@dataclass(frozen=True)
class CleaningParams:
    """Text filter: length and script counts are in code points."""

    min_length: int = 1
    min_script_chars: int = 2
    strip_emoji: bool = True
    script: Ranges = CJK_IDEOGRAPHS

    def __post_init__(self) -> None:
        _at_least("min_length", self.min_length, 0)
        _at_least("min_script_chars", self.min_script_chars, 0)


@dataclass(frozen=True)
class LabelingParams:
    """Batching, retry and repair limits of a labeler call."""

    batch_size: int = 100
    max_retries: int = 5
    retry_delay: float = 30.0
    batch_pause: float = 0.3
    max_rounds: int = 8
    #: Labeler calls a second over all tasks; None sets no bound.
    max_rate: float | None = None

    def __post_init__(self) -> None:
        if self.max_rate is not None and self.max_rate <= 0:
            raise ValueError(f"max_rate must be above 0, got {self.max_rate}")
        _at_least("batch_size", self.batch_size, 1)
        _at_least("max_retries", self.max_retries, 0)
        _at_least("retry_delay", self.retry_delay, 0)
        _at_least("batch_pause", self.batch_pause, 0)
        _at_least("max_rounds", self.max_rounds, 1)


@dataclass(frozen=True)
class SplitParams:
    test_size: float = 0.2
    seed: int = 42
    by: str = "primary"
    on_small_class: str = "error"

    def __post_init__(self) -> None:
        if not 0.0 < self.test_size < 1.0:
            raise ValueError(f"test_size must lie strictly between 0 and 1, got {self.test_size}")
        if self.on_small_class not in ("error", "train"):
            raise ValueError(f"on_small_class must be 'error' or 'train', got {self.on_small_class!r}")


@dataclass(frozen=True)
class LabelRules:
    """Keyword rules of the built-in labeler.

    Every pattern is a regular expression tried on the lower-cased text.
    ``nature`` is in falling severity: the first match wins.  ``area`` entries
    are independent of it; a text that touches no area, or several, is general.
    """

    nature: tuple[tuple[str, str], ...] = (
        ("BUG", "crash|error|bug|fail|freez|not work|閃退|當機|錯誤|故障|失敗|無法|闪退|错误|失败|无法"),
        ("UI/UX", "interface|layout|design|button|font|confus|介面|界面|版面|按鈕|字體|操作|難用|按钮|字体|难用"),
        ("PERFORMANCE", "slow|lag|loading|stuck|timeout|很慢|太慢|卡頓|延遲|讀取|卡顿|延迟"),
        ("FEATURE_REQUEST", "please add|wish|feature|suggest|would like|希望|建議|新增|功能|增加|建议"),
        ("POSITIVE", "great|good|love|excellent|thank|best|很好|好用|方便|喜歡|讚|感謝|喜欢|赞|感谢"),
    )
    area: tuple[tuple[str, str], ...] = (
        ("ACCOUNT", "login|log in|sign in|password|account|balance|登入|密碼|帳號|帳戶|餘額|登录|密码|账号|余额"),
        ("TRANSACTION", "transfer|payment|remit|qr code|pay |轉帳|付款|匯款|支付|掃碼|转账|汇款|扫码"),
        ("CREDIT_CARD", "credit card|statement|reward|cashback|信用卡|帳單|回饋|刷卡|账单|回馈"),
    )
    primary_fallback: str = field(default=PRIMARY_FALLBACK)
    secondary_fallback: str = field(default=SECONDARY_FALLBACK)
