"""What differs between the sources, as data: one frozen specification each."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Patterns of template and fulfilment remarks; the first that matches names the reason for removal.
TEMPLATES_EN = (
    r"\b(as expected|works as expected|just as described)\b",
    r"\b(fast shipping|quick shipping|arrived (on time|quickly|early))\b",
    r"\b(great product|good product|nice product|excellent product)\b",
    r"\b(would buy again|will buy again|recommend this product)\b",
    r"\b(five stars|four stars|three stars|two stars|one star)\b",
    r"^\s*(good|great|excellent|perfect|nice|ok|okay|love it|liked it)[.!]?\s*$",
)
TEMPLATES_VI = (
    r"\b(giao hàng nhanh|ship nhanh|đóng gói (cẩn thận|chắc chắn)|giao đúng hàng)\b",
    r"\b(hàng (đẹp|tốt|ổn|chất lượng)|sản phẩm (đẹp|tốt|ổn|chất lượng))\b",
    r"\b(sẽ ủng hộ|ủng hộ shop|nên mua|đáng mua)\b",
    r"^\s*(tốt|đẹp|ổn|ok|oke|ưng|rất tốt|rất đẹp|hài lòng)[.!]?\s*$",
)
TEMPLATE_CHARS = 220
ASSIGNMENTS = ("direct", "structured_claim", "summary_inference")


@dataclass(frozen=True)
class SourceSpec:
    """Thresholds are inclusive. 0 means no limit. Weighted metrics are summed in the order given."""

    name: str
    shards: int = 256
    top_k: int = 100_000
    max_users: int = 0
    min_count: int = 5
    min_chars: int = 1_000
    min_verified: float | None = None
    years: tuple[int, int] | None = None
    keep_undated: bool = False
    weights: dict[str, float] = field(default_factory=dict)
    ties: tuple[str, ...] = ()
    ordinal: bool = False
    templates: tuple[str, ...] = ()
    filter_templates: bool = False
    cascade: str = "review"
    min_text: int = 20
    split: float | None = None
    min_rows: int = 2
    profile_chars: int = 48_000
    text_chars: int = 2_000
    newest: int = 0
    whole_items: bool = False
    chunk: int = 50
    coerce: str = "dash"
    concurrency: int = 1
    title: str = ""

    def __post_init__(self):
        if self.shards < 1 or self.top_k < 1 or self.min_count < 0 or self.max_users < 0:
            raise ValueError("shards and top_k must be positive, limits not negative")
        if self.split is not None and not 0 < self.split < 1:
            raise ValueError("split must lie between 0 and 1")
        if self.years and self.years[0] > self.years[1]:
            raise ValueError("years must be in order")

    def but(self, **changes) -> SourceSpec:
        return replace(self, **changes)


REVIEWS_INTL = SourceSpec(
    "reviews_intl", min_count=30, min_chars=2_000, min_verified=0.70, years=(2018, 2023),
    weights={"text_chars": 0.35, "text_items": 0.20, "categories": 0.20, "history_days": 0.15, "items": 0.05, "verified_share": 0.05},
    ties=("text_chars", "categories", "history_days"), templates=TEMPLATES_EN, filter_templates=True, split=0.8,
    profile_chars=15_000, text_chars=1_500, chunk=10, concurrency=5, title="Product reviewer profile",
)
REVIEWS_VN = SourceSpec(
    "reviews_vn", weights={"text_chars": 0.35, "text_items": 0.20, "categories": 0.20, "history_days": 0.15, "items": 0.10},
    ties=("text_chars", "categories", "text_items"), templates=TEMPLATES_VI, cascade="shop", title="Online shop reviewer profile",
)
QA_POSTS = SourceSpec(
    "qa_posts", min_count=2, min_chars=200, keep_undated=True,
    weights={"text_chars": 0.35, "items": 0.25, "categories": 0.20, "history_days": 0.10, "score_sum": 0.10}, ties=("text_chars", "items"),
    ordinal=True, cascade="qa", split=0.8, profile_chars=70_000, newest=90, whole_items=True, coerce="exact", title="",
)
FORUM_POSTS = SourceSpec(
    "forum_posts", shards=50, top_k=100, weights={"text_chars": 0.35, "text_items": 0.20, "categories": 0.20, "history_days": 0.15, "items": 0.10},
    ties=("text_chars", "categories", "text_items"), cascade="forum", profile_chars=35_000, coerce="hyphen", title="Forum member profile",
)
SPECS = {s.name: s for s in (REVIEWS_INTL, REVIEWS_VN, QA_POSTS, FORUM_POSTS)}
